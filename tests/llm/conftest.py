import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, body string, ids long, key string, sequence_id int, digest string, rank int, doc string, suspect boolean"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, null identifiers, ties, repeated rows, near copies and a very long text."""
    rng = random.Random(7)
    long_line = "a line of more than forty characters that stands in many documents"
    base = _words(rng, 60)
    near = base.split()
    near[30] = "changed"
    texts = [
        None, "", "   \t\n ", "one", "Two Words", "one two three", base, base, " ".join(near), base.upper(), "x" * 3000,
        "\n".join([long_line, _words(rng, 9), "  " + long_line.upper() + " "]), "\n".join([_words(rng, 9), long_line]), long_line, long_line + "\n" + long_line,
        long_line + "\r\nlast", "ÄÖÜ ñandú élève naïve ß – “quotes” 日本語 🙂", _words(rng, 4000), "don't we'll  stop\u00a0here\x85now", "<|endoftext|> and <|startoftext|>",
    ]
    texts += [long_line + f"\nown line number {i}" for i in range(4)]
    rows = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], (None, base, "en", None, None), (None, "alone without identifier", None, None, None), (None, None, None, None, None)]
    return [(*r, "clash", 1, "clash", 2, "clash", 3, "clash", True) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
