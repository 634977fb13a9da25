import random

import pytest

from tidewake.llm import language_id

FINNISH = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. "


@pytest.fixture(scope="module")
def judge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = docs.filter(~language_id.held_out(docs["doc_id"]))
    slices = language_id.samples(learn)
    least, classifier = language_id.limits(slices), language_id.Classifier(language_id.fit(slices))
    held = [(r["text"], r["lang"]) for r in docs.filter(language_id.held_out(docs["doc_id"])).select("text", "lang").collect()]
    return lambda text: classifier.judged(text, least), held


def test_junk_and_languages_not_learned_are_rejected(judge):
    judge, held = judge
    rng = random.Random(3)
    for n in (60, 250, 1000, 4000):
        for _ in range(20):
            assert judge("".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)))[2]
    for n in (20, 200, 500):
        assert judge(" ".join(f"{rng.getrandbits(32):08x}" for _ in range(n)))[2]
    assert judge(FINNISH)[2] and judge(FINNISH * 5)[2]
    parts = [next(t for t, x in held if x == lang and len(t) > 1500)[:1000] for lang in ("de", "en", "es", "fr")]
    assert judge("\n".join(parts))[2]


def test_labelled_and_short_texts_are_kept(judge):
    judge, held = judge
    answers = [(judge(t), lang, t) for t, lang in held if t and any(c.isalpha() for c in t)]
    assert sum(a[2] for a, _, _ in answers) <= 0.02 * len(answers)
    assert sum(a[0] == lang for a, lang, _ in answers) >= 0.98 * len(answers)
    # One word is too little where bytes and grams do not agree on it.
    assert judge("Die tz.")[::2] == ("de", False) and judge("Éaux.")[2]
    short = [" ".join(t.split()[:6]) for t, lang in held if lang == "fr"]
    assert sum(judge(t)[2] for t in short) <= 0.1 * len(short)


def test_few_labelled_rows_leave_the_least_margin():
    assert language_id.limits({"a": [b"one two three"], "b": []}) == language_id.Limits() == language_id.limits({})
