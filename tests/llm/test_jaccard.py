import collections
import random
import re

import pytest

from tidewake.llm import jaccard_join, queries
from tidewake.llm.components import connected_components

from .conftest import SF


def brute(rows, width, percent):
    """``(doc_id, set size, component)`` by comparing every pair of sets."""

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if not words:
            return frozenset()
        return frozenset([tuple(words)]) if len(words) < width else frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))

    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    known = [(i, s) for i, s in sets if i is not None and s]
    for n, (a, x) in enumerate(known):
        for b, y in known[:n]:
            if 100 * len(x & y) >= percent * len(x | y):
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    same = {s: root(i) for i, s in known}
    return collections.Counter((i, len(s), (root(i) if s else i) if i is not None else same.get(s)) for i, s in sets)


def result(df):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_query(spark, table):
    assert result(queries.QUERIES["op3_jaccard_join"](spark, SF)) == brute(list(table.items()), 4, 85)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_odd_rows(odd, odd_rows, width, percent):
    assert result(jaccard_join.similar_groups(odd, width, percent)) == brute(odd_rows, width, percent)


def test_empty_table(nothing):
    assert jaccard_join.similar_groups(nothing).collect() == []
    assert jaccard_join.one_of_each(nothing).columns == nothing.columns


def test_families_of_many_degrees(spark):
    rng, rows = random.Random(11), []
    for _ in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        for _ in range(60):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 8])):
                words[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jaccard_join.similar_groups(docs, 4, 85)) == brute(rows, 4, 85)


def test_blocks_do_not_matter(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    prefixes = [np.unique(rng.integers(0, 40, 25)) for _ in range(50)]
    n, matches = np.array([len(x) + 5 for x in prefixes]), np.array([1 + i % 9 for i in range(50)])
    pairs = lambda: {(int(a), int(b)) for x, y in jaccard_join.bucket_pairs(np.arange(50), np.arange(50) % 20, n, matches, prefixes, 60) for a, b in zip(x, y, strict=True)}
    whole = pairs()
    asked = lambda a, b: -(-60 * (n[a] + n[b]) // 160) + min(matches[i] - -(-60 * n[i] // 100) for i in (a, b))
    want = {(a, b) for a in range(50) for b in range(a + 1, 50) if a % 20 != b % 20 and 100 * min(n[a], n[b]) >= 60 * max(n[a], n[b]) and (asked(a, b) <= 1 or len(np.intersect1d(prefixes[a], prefixes[b])) >= asked(a, b))}
    assert whole == want
    monkeypatch.setattr(jaccard_join, "PAIR_BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "VOCABULARY_BLOCK", 5)
    assert pairs() == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 199)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(chain, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100, 199: 199, 200: 199}


def test_shingles_by_pieces_and_against_sets(monkeypatch):
    rng = random.Random(4)
    words = ["the", "Ä", "ä", "x" * 90, "日本", "a b", "end.", "\x85"]
    texts = ["", "  ", "one", "One two", *("".join(rng.choice(words) + rng.choice([" ", "\n", "\t\t", "\x0b"]) for _ in range(n)) for n in (3, 4, 5, 50, 400))]
    bodies = [t.encode() for t in texts]

    def lowered(text):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))

    whole = jaccard_join.shingle_sets(bodies, 4)
    for text, found in zip(texts, whole, strict=True):
        w = lowered(text)
        assert len(found) == (len({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))}) if w else 0)
    monkeypatch.setattr(jaccard_join, "BYTES_AT_ONCE", 60)
    for a, b in zip(whole, jaccard_join.shingle_sets(bodies, 4), strict=True):
        assert a.tolist() == b.tolist()


def test_blocks_of_a_token_lose_no_pair(spark, monkeypatch):
    """Documents of one template with a common passage: every pair of blocks is looked at."""
    monkeypatch.setattr(jaccard_join, "PAIR_BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 6)
    monkeypatch.setattr(jaccard_join, "BODIES_BY_HUB", 3)
    rng, rows = random.Random(12), []
    base = [f"w{i}" for i in range(40)]
    for i in range(40):
        words = [*base, *(f"o{rng.randrange(10**6)}" for _ in range(rng.choice([0, 2, 4, 8, 30])))]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(jaccard_join.similar_groups(docs, 4, 85)) == brute(rows, 4, 85)


def test_words_made_to_collide_stay_apart(spark):
    """Words that follow the Thue-Morse sequence agree under any polynomial modulo a power of two."""
    signs = [bin(i).count("1") % 2 for i in range(2048)]
    word = lambda a, b, k: "".join((a, b)[x ^ k] for x in signs)
    pairs = [("a" + chr(98 + i), "z" + chr(98 + i)) for i in range(12)]
    texts = [" ".join(word(a, b, k) for a, b in pairs) for k in (0, 1)]
    assert len({*texts[0].split(), *texts[1].split()}) == 24
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, texts[0])], "doc_id long, text string")
    assert result(jaccard_join.similar_groups(docs, 4, 85)) == brute([(1, texts[0]), (2, texts[1]), (3, texts[0])], 4, 85)
