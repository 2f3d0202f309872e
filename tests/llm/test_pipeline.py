import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

from chirpstat.llm import decontaminate, jaccard_join, langid, mixing, token_dac  # noqa: E402
from chirpstat.llm.common import id_remainder  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and output rows of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_and_columns(steps, spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixture", "token_files"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    for _, _, after in steps[:-1]:
        assert after.columns == columns


def test_each_stage_against_its_operator(steps, spark):
    _, before, after = steps[0]
    rest = id_remainder(F.col("doc_id"), 4)
    model = langid.learn(before.select("doc_id", "text", "lang").where(rest != 2), rest == 3)
    kept = {r.doc_id for r in before.select("doc_id", langid.verdicts(spark, model)(F.col("text")).alias("v")).collect() if not r.v.rejected}
    assert {r.doc_id for r in after.collect()} == kept and len(kept) >= before.count() * 0.98

    from .test_jaccard_join import brute

    _, before, after = steps[1]
    classes = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for c, _ in classes.values()})

    _, before, after = steps[2]
    items = [decontaminate.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {r.doc_id for r in before.collect() if any(f" {' '.join(i)} " in f" {' '.join(decontaminate.words_of(r.text))} " for i in items)}
    left = {r.doc_id for r in after.collect()}
    assert leaky and not leaky & left and {r.doc_id for r in before.collect()} - left == leaky

    _, before, after = steps[3]
    plan = {r.doc_id: r.copies for r in mixing.plan(before).collect()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, n in plan.items() for _ in range(n))

    _, before, after = steps[4]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in before.collect())
    encoder = token_dac.TextEncoder(__import__("public_tokenizers").path("byte_bpe_50k.json"))
    lens = {r.doc_id: len(encoder.encode(r.text)) // 4 + 1 for r in before.collect()}
    assert all(r.n_tokens == lens[r.doc_id] for r in after.collect())
    assert jaccard_join.Join().threshold == 0.8


def test_run_gives_the_last_stages_rows(steps, spark):
    want = sorted(map(tuple, steps[-1][2].collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want


def test_odd_documents_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        assert docs.columns[:3] == ["doc_id", "start", "n_tokens"]
