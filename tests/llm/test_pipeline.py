"""The pipeline's stages on the smallest documents, each against what its operator reports on the same input."""

import corpus_pipeline
from tests.llm.test_similar import plain_kept
from veritrail.llm import mixing, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        got = spark.read.parquet(f"{tmp_path}/{k}")
        ids = sorted(r.doc_id for r in got.select("doc_id").collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert got.columns == docs.columns
        if name == "quality rules":
            assert ids == sorted(r.doc_id for r in quality.quality_report(docs, labels).filter("kept").collect())
        elif name == "SimHash near-dedup":
            assert ids == plain_kept([(r.doc_id, r.text) for r in docs.collect()])[0]
        elif name == "suffix-array dedup":
            assert ids == sorted(r.doc_id for r in docs.collect())
        elif name == "source mixing":
            sizes = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix_report(docs).collect()}
            assert all(ids.count(d) * n == t for d, (t, n) in sizes.items())
        else:
            assert set(ids) == {r.doc_id for r in docs.collect()}
        docs = got


def test_odd_tables(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, columns with clashing names; and no rows at all."""
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    good = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, None, None, None, None), (None, "", "en", None, 0), (900001, "\u00e9 " * 60, None, "a", None), (900001, "\u00e9 " * 60, None, "a", None), (900002, " \n", "de", "", 2)]
    odd = good.unionByName(spark.createDataFrame(rows, good.schema)).unionByName(good.limit(5))
    odd = odd.withColumns({"n": odd["n_chars"], "_key": odd["source"], "bytes": odd["text"], "odd.name": odd["lang"], "root": odd["doc_id"], "H": odd["text"]})
    for k, docs in enumerate((odd, odd.limit(0))):
        columns = docs.columns
        for j, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}-{j}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{j}")
            assert j == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        assert (docs.count() > 0) == (k == 0)


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
