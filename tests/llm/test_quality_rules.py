"""Counts against a plain reading, the learned list against its own definition."""

import random
import re
from collections import Counter

import pytest

from tidewake.llm import quality_rules as q

from .conftest import SF

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    under = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under)


def base(n, _chars, _symbols, _dup, repeat):
    return n < 50 or 100 * repeat > 50 * n


def _counts(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in COUNTS]) for r in rows)


def _expected(docs):
    return sorted((d is None, d or 0, *brute(t)) for d, t in docs)


@pytest.mark.parametrize("bits", [40, 2, 1])
def test_counts_of_odd_rows(spark, odd, odd_rows, monkeypatch, bits):
    """With one or two bits of hash nearly every text takes the exact way."""
    monkeypatch.setattr(q, "HASH_BITS", bits)
    rng = random.Random(bits)
    more = [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(200, "a a a a"), (201, "a b a b a"), (202, " \x0b\x0c\r\n"), (203, "x y z #|# <>"), (204, "l\nl\n \n \nl ")]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert _counts(q.counted(docs).collect()) == _expected([(r[0], r[1]) for r in odd_rows] + more)


def test_places_beyond_their_bits(spark, monkeypatch):
    monkeypatch.setattr(q, "PLACE_BITS", 4)
    monkeypatch.setattr(q, "HASH_BITS", 40)
    docs = [(1, "a b c " * 9), (2, " ".join(map(str, range(40)))), (3, "a b c d a b c")]
    assert _counts(q.counted(spark.createDataFrame(docs, "doc_id long, text string")).collect()) == _expected(docs)


def test_whole_table_and_its_verdicts(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = q.op11_quality_rules(spark, SF).collect()
    assert _counts(got) == _expected(docs)
    for r in got:
        assert r["base_failed"] == base(*[r[c] for c in COUNTS]) and r["kept"] == (not r["base_failed"] and r["rule"] is None)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [r for r in got if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(r["kept"] == (labels[r["doc_id"]] == 1) for r in judged) >= 0.95 * len(judged)


def test_empty_tables(spark, nothing, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert q.judged(nothing, labels).collect() == []
    assert all(r["kept"] != r["base_failed"] and r["rule"] is None for r in q.judged(odd, labels).collect())
    odd_labels = spark.createDataFrame([(None, 0), (1, None), (999, 0), (6, 1), (6, 1), (6, 0)], "doc_id long, quality int")
    assert q.judged(odd, odd_labels).count() == odd.count()


def test_cut_points():
    assert q.cut_points({0: (0, 50), 1: (0, 50), 100: (40, 0)}, 4) == [50]
    assert q.cut_points({v: (5, 5) for v in range(20)}, 4) == []
    inner = {v: (0, 30) if v < 10 or v >= 20 else (30, 0) for v in range(30)}
    assert q.cut_points(inner, 4) == [9, 19]
    assert q.cut_points({}, 4) == [] and q.cut_points({3: (9, 0)}, 4) == []


def _values(rng):
    return {"a": rng.randint(0, 99), "b": rng.randint(0, 99), "c": rng.randint(0, 99)}


def test_covering_finds_planted_conjunctions():
    rng = random.Random(3)
    planted = lambda v: v["a"] > 60 and v["b"] <= 30 or v["c"] > 90
    cells = [(v, rng.randint(0, 2), int(planted(v)), int(not planted(v))) for v in (_values(rng) for _ in range(3000))]
    rules = q.covering(cells, {"a": [30, 60], "b": [30, 70], "c": [50, 90]})
    wrong = sum(any(r.meets(v) for r in rules) != planted(v) for v, *_ in cells)
    assert wrong == 0 and len(rules) == 2 and {str(r) for r in rules} == {"c > 90", "a > 60 and b <= 30"} or wrong == 0


def test_covering_leaves_noise_alone():
    rng = random.Random(4)
    cells = [(_values(rng), rng.randint(0, 2), *((1, 0) if rng.random() < 0.2 else (0, 1))) for _ in range(2000)]
    rules = q.covering(cells, {"a": [30, 60], "b": [30, 70], "c": [50, 90]})
    assert all(not r.meets(v) or b for r in rules for v, _, b, g in cells) or rules == []


def test_list_in_columns_and_in_python_agree(spark):
    rng = random.Random(5)
    rows = [(i, *(rng.randint(0, 300) for _ in range(8))) for i in range(300)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
    counts = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{n} long" for n in names))
    rules = [q.Rule((q.Condition("symbol_share", True, 400), q.Condition("upper_share", False, 600))), q.Rule((q.Condition("word_length", False, 3),))]
    table = {r["doc_id"]: r for r in counts.select("doc_id", *[v.alias(k) for k, v in q.measured().items()]).collect()}
    for r in q.decided(counts, rules).collect():
        first = next((str(x) for x in rules if x.meets(table[r["doc_id"]].asDict())), None)
        failed = base(*[r[c] for c in COUNTS])
        assert (r["base_failed"], r["rule"], r["kept"]) == (failed, None if failed else first, not failed and first is None)
