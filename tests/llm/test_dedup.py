import hashlib
import random

import duckdb
import pytest

from tidewake.llm import exact_dedup, line_dedup, queries
from tidewake.llm.exact_dedup import PatriciaTrie

from .conftest import SF


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine, theirs = queries.QUERIES[name](spark, SF), con.sql(queries.SQL[name])
    order = sorted(mine.columns)
    assert order == sorted(theirs.columns)
    assert sorted(map(repr, map(tuple, mine.select(*order).collect()))) == sorted(map(repr, theirs.select(*order).fetchall()))


@pytest.mark.parametrize("budget", [1 << 30, 400])
@pytest.mark.parametrize("largest", [True, False])
def test_trie_with_and_without_spills(budget, largest):
    rng = random.Random(5)
    words = ["", "a", "ab", "abc", "b" * 500, "b" * 499 + "c"] + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(300)]
    trie, want = PatriciaTrie(budget, largest), {}
    for i, w in enumerate(words * 2):
        owner = None if i % 17 == 0 else i
        trie.insert(w.encode(), hashlib.sha256(w.encode()).digest(), owner, 1 + i % 3)
        best, size = want.get(w, (None, 0))
        if owner is not None:
            best = owner if best is None else max(best, owner) if largest else min(best, owner)
        want[w] = (best, size + 1 + i % 3)
    got = {t.digest: (n, t.owner, t.size) for n, t in trie.drain()}
    assert got == {hashlib.sha256(w.encode()).digest(): (len(w), *x) for w, x in want.items()}
    assert len(list(PatriciaTrie().drain())) == 0


def test_exact_dedup_of_odd_rows(odd, odd_rows, nothing):
    groups = {}
    for r in odd_rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    for keep, choose in (("largest", max), ("smallest", min)):
        out = exact_dedup.exact_duplicates(odd, keep, trie_bytes=500).collect()
        assert len(out) == len(odd_rows)
        by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        for r in out:
            ids = by_digest[r["text_sha256"]]
            known = [i for i in ids if i is not None]
            assert r["group_size"] == len(ids) and r["keep_id"] == (choose(known) if known else None) and r["kept"] == (r["doc_id"] == r["keep_id"])
    assert exact_dedup.exact_duplicates(nothing).collect() == []


def brute_lines(rows, min_docs=5):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in t.split("\n")]
    holders = {}
    for r in rows:
        if r[0] is not None:
            for k in keys(r[1] or ""):
                if len(k) >= 40:
                    holders.setdefault(k, set()).add(r[0])
    gone = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x, k in zip(lines, keys(r[1] or ""), strict=True) if r[0] is None or k not in gone or gone[k] == r[0]]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [None, line_dedup.BLOCK_BITS])
def test_line_dedup_of_odd_rows(odd, odd_rows, bits):
    out = line_dedup.dedup_lines(odd, bits=bits).selectExpr("doc.doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, out.collect()), key=repr) == brute_lines(odd_rows)


def test_line_dedup_when_the_filter_is_full(odd, odd_rows):
    out = line_dedup.dedup_lines(odd, bits=64).selectExpr("doc.doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, out.collect()), key=repr) == brute_lines(odd_rows)


def test_line_dedup_keeps_columns_and_takes_empty_tables(odd, nothing):
    assert line_dedup.cleaned(odd).columns == odd.columns and line_dedup.cleaned(nothing).collect() == []
