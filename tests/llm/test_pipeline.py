"""Each stage against a brute-force reading of what it decides."""

import corpus_pipeline
from tidewake.llm import language_id, pii

from .conftest import SF
from .test_dedup import brute_lines
from .test_jaccard import brute


def test_stages_in_order_on_their_own_inputs(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near copies", "personal data", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    clear = {r["doc_id"] for r in language_id.identify(docs).filter("not rejected").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        rows = docs.collect()
        if name == "language":
            assert {r["doc_id"] for r in rows} == clear and all(r == before[r["doc_id"]] for r in rows)
        elif name == "lines":
            assert {r["doc_id"]: r["text"] for r in rows} == {x[0]: x[3] for x in brute_lines([(r["doc_id"], r["text"]) for r in before.values()])}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "near copies":
            groups = brute([(r["doc_id"], r["text"]) for r in before.values()], 5, 80)
            assert {r["doc_id"] for r in rows} == {c for _, _, c in groups} and all(r == before[r["doc_id"]] for r in rows)
        elif name == "personal data":
            real = {(k, f) for r in before.values() for _, _, k, f in pii.entities(r["text"])}
            assert {r["doc_id"] for r in rows} == set(before) and not real & {(k, f) for r in rows for _, _, k, f in pii.entities(r["text"])}
        else:
            assert {r["doc_id"] for r in rows} == set(before)
            continue
        assert docs.columns == columns
        before = {r["doc_id"]: r for r in rows}


def test_stages_take_odd_rows_and_empty_tables(spark, odd, odd_rows, nothing, tmp_path):
    docs = odd
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == odd.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}") if i else odd
    kept = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert kept <= {r[0] for r in odd_rows} and None in kept
    assert {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/4").collect()} == kept
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name


def test_run_packs_what_the_stages_keep(spark):
    out = corpus_pipeline.run(spark, SF)
    assert "sequence_id" in out.columns and 0 < out.select("doc_id").distinct().count() <= spark.read.parquet(f"{SF}/documents.parquet").count()
