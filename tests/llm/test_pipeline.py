"""The pipeline against its stages done by brute force on a small table."""

import corpus_pipeline
from pyspark.sql import functions as F

from salesflow.llm import langid, queries

from . import test_simhash, test_suffixes
from .data import documents, sorted_rows
from .test_packing import oracle


def table(spark):
    rows = [(i, t) for i, t in documents(5, 60) if i is not None and i not in (7, 8)]
    return rows, spark.createDataFrame([(i, t, "en" if i % 3 else "de", "s", len(t or "")) for i, t in rows],
                                       "doc_id long, text string, lang string, source string, n_chars long")


def test_run_against_brute_force(spark, tmp_path):
    _, df = table(spark)
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted_rows(corpus_pipeline.run(spark, f"file://{tmp_path}"))
    score = {r.doc_id: r.score for r in langid.identify(df).collect()}
    left = [(r.doc_id, r.text) for r in df.collect() if score[r.doc_id] >= langid.least_score(2)]
    first = {d for d, _, c in test_simhash.brute(left) if d == c}
    left = [(d, t) for d, t in left if d in first]
    seen, kept = {}, []
    for d, t in left:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            seen[b[p:p + 50]] = min(seen.get(b[p:p + 50], d), d)
    for d, t in left:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen[b[p:p + 50]] < d:
                gone[p:p + 50] = b"\1" * 50
        kept.append((d, bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")))
    assert got == sorted(oracle(kept), key=str)
    assert test_suffixes.brute(left)


def test_stages_keep_the_columns_of_documents(spark):
    _, df = table(spark)
    assert len(corpus_pipeline.STAGES) == 4
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and out.dtypes == df.dtypes
        empty = stage(spark, df.limit(0), "")
        assert empty.columns == df.columns and empty.count() == 0
    assert corpus_pipeline.pack(spark, df.limit(0), "").count() == 0


def test_changed_texts_have_their_new_length(spark):
    _, df = table(spark)
    out = corpus_pipeline.repeated_passages(spark, df, "")
    assert out.where(F.length(F.coalesce("text", F.lit(""))) != F.col("n_chars")).count() == 0


def test_shared_and_missing_ids_lose_no_group(spark):
    """With the ids that two texts share and the rows without an id."""
    rows = documents(5, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted_rows(corpus_pipeline.near_duplicates(spark, df, "")) == test_simhash.one_of_each(rows)


def test_registered_names():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)
