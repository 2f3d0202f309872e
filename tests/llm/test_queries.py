"""Every registered query over small tables of odd rows, and over empty ones."""

import pytest
from pyspark.sql import functions as F

from chirpstat.llm.registry import QUERIES

KEYS = {"op6_html_main": "page_id", "op11_centroids": "vec_id", "op12_part_codes": "vec_id", "op13_vector_links": "vec_id"}


@pytest.fixture(scope="module")
def tables(spark, odd_docs, tmp_path_factory):
    """Folders of odd rows and of empty tables."""
    vectors = [[float((v * 7 + k) % 11) for k in range(64)] for v in range(6)]
    embeddings = [(1, vectors[0], 1), (1, vectors[0], 1), (2, vectors[1], 1), (None, vectors[2], 1), (3, vectors[3], None), (4, None, 2), (5, [float("nan")] * 64, 2)]
    frames = {
        "documents": odd_docs,
        "labels": spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 0), (6, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, "one two three four five six"), (None, None), (2, "")], "item_id long, text string"),
        "pages": spark.createDataFrame([(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, None)], "page_id long, url string, html string"),
        "embeddings": spark.createDataFrame(embeddings, "vec_id long, embedding array<float>, label int"),
    }
    out = {}
    for kind in ("odd", "empty"):
        out[kind] = str(tmp_path_factory.mktemp(kind))
        for name, frame in frames.items():
            (frame if kind == "odd" else frame.limit(0)).write.parquet(f"{out[kind]}/{name}.parquet")
    return out


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_on_odd_and_empty_tables(spark, tables, name):
    """A row of the result for each row of the table (op3: for each leak; op11, op12: for each vector they keep); nothing for an empty one."""
    assert QUERIES[name](spark, tables["empty"]).collect() == []
    got = QUERIES[name](spark, tables["odd"])
    key = KEYS.get(name, "doc_id")
    source = {"page_id": "pages", "vec_id": "embeddings"}.get(key, "documents")
    ids = spark.read.parquet(f"{tables['odd']}/{source}.parquet").select(F.col(key)).collect()
    if name in ("op11_centroids", "op12_part_codes"):
        ids = [r for r in ids if r[0] not in (4, 5)]
    if name == "op3_decontaminate":
        assert got.collect() == []
    else:
        assert sorted((r[key] is None, r[key] or 0) for r in got.select(key).collect()) == sorted((r[0] is None, r[0] or 0) for r in ids)


@pytest.mark.parametrize("name", ["op1_token_dac", "op2_langid", "op5_lm_scoring", "op7_mixing", "op9_jaccard_join"])
def test_query_has_each_document_once(spark, name):
    sf = "/root/testdata/sf0.001"
    got = QUERIES[name](spark, sf).select("doc_id").collect()
    ids = sorted(r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())
    assert (set if name == "op7_mixing" else list)(sorted(r[0] for r in got)) == (set if name == "op7_mixing" else list)(ids)
