import corpus_pipeline
import pytest
from edges import frame, words
from pyspark.sql import functions as F

from grainmill.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"
    ]
    assert len(queries.queries()) == 11


def test_each_stage_takes_effect(spark, tmp_path):
    item = words(900, 40)
    good = [(i, words(i, 100 + i), "en", "s", 0) for i in range(30)]
    bad = [(50, "too short", "en", "s", 0), (51, "again and " * 100, "en", "s", 0)]
    copies = [(60 + i, good[3][1] + " tail", "en", "s", 0) for i in range(3)]
    leak = [(70, f"{words(71, 80)} {item} {words(72, 80)}", "en", "s", 0)]
    secret = [(80, f"{words(81, 80)} token = {'ab12' * 10} end", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(good + bad + copies + leak + secret, schema)
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, columns = [], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    keep = {r[0] for r in good} | {80}
    assert seen[0] == keep | {60, 61, 62, 70}
    assert keep - {3} <= seen[1] and len(seen[1] & {3, 60, 61, 62}) <= 2 and 70 in seen[1]
    assert seen[2] == seen[1] - {70} == seen[3]
    masked = docs.where("doc_id = 80").first()
    assert "[SECRET] end" in masked.text and masked.n_chars == len(masked.text)
    assert set(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == seen[3]


@pytest.mark.parametrize("name", [q for q in queries.queries() if q != "pipeline"])
def test_query(spark, name):
    got = queries.queries()[name](spark, FOLDER)
    assert got.columns[0] == "doc_id" and got.count() > 0


def test_pipeline_stands_odd_rows(spark, tmp_path):
    frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame(spark).columns
    assert {5, None} <= {r.doc_id for r in docs.collect()}
    frame(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
