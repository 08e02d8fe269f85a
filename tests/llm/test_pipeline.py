"""Stage contracts of the pipeline, its queries and their oracles on the smallest tables."""

import collections

import duckdb
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from intakeyard.llm.queries import ORACLE, QUERIES  # noqa: E402
from intakeyard.sources.tables import load  # noqa: E402
from tests.llm.test_operators import brute_components, brute_contamination  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    got = QUERIES[name](spark, SF).select(*cols)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_hard_negatives"}))
def test_one_row_per_document(spark, name):
    docs = load(spark, SF, "documents")
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_stages(spark, tmp_path):
    docs = load(spark, SF, "documents")
    columns, before = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        a, b = ([(r.doc_id, r.text) for r in d.collect()] for d in (before, docs))
        if name == "line dedup":
            assert sorted(x[0] for x in a) == sorted(x[0] for x in b)
        elif name == "MinHash near-dedup":
            assert sorted(x[0] for x in b) == sorted({c for _, _, c in brute_components(a, 80)})
        elif name == "benchmark decontamination":
            items = [(r.item_id, r.text) for r in load(spark, SF, "benchmark").collect()]
            assert sorted(x[0] for x in b) == sorted(r[0] for r in brute_contamination(a, items) if not r[5])
    assert {"n_tokens", "ids_sha256", "decoded_sha256"} <= set(docs.columns)


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (3, None), (4, "")], "doc_id long, text string")
    out = corpus_pipeline.near_dedup_stage(spark, docs, SF)
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(1, "a b c d e f g"), (3, ""), (4, "")]


CLASHES = ["score", "predicted", "n_hit", "n_words", "n_items", "items_sha256", "contaminated", "kept_text", "n_lines", "n_dropped", "__key", "__row",
           "__n", "__text", "__gone", "key", "row", "n", "component_id", "column_0"]


def test_columns_that_clash_pass_through(spark, tmp_path):
    """Columns named like what a stage adds or uses come out as they went in, with their types."""
    from pyspark.sql import functions as F

    docs = load(spark, SF, "documents").limit(60)
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in CLASHES])
    docs.write.parquet(f"{tmp_path}/in")
    docs = before = spark.read.parquet(f"{tmp_path}/in")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in before.schema]
    assert docs.count() > 0
    assert all(r[c] == f"{c} of {r.doc_id}" for r in docs.collect() for c in CLASHES)


def test_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        part = load(spark, SF, t)
        (part.limit(0) if t == "documents" else part).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
