"""The pipeline's stages, each on its own input, and its run."""

from collections import Counter

import corpus_pipeline
import pytest
from test_near import brute_kept


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_each_stage_returns_the_columns_of_documents(spark, docs, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, nothing, "").count() == 0


def test_language_stage_keeps_clean_documents(spark, docs):
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, docs, "").select("doc_id").collect()}
    clean = {r.doc_id for r in docs.collect() if r.text and sum(c.isalpha() for c in r.text) > 40}
    assert clean <= kept


def test_copies_stages(spark, docs, awkward):
    for rows in (docs, awkward):
        all_rows = rows.collect()
        kept = corpus_pipeline.exact_stage(spark, rows, "").collect()
        low = lambda t: (t or "").translate({i: i + 32 for i in range(65, 91)})
        best = {}
        for r in all_rows:
            best[low(r.text)] = max(best.get(low(r.text), -1), -1 if r.doc_id is None else r.doc_id)
        assert Counter((low(r.text), -1 if r.doc_id is None else r.doc_id) for r in kept) == Counter(best.items())
    near = {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").select("doc_id").collect()}
    assert near == brute_kept(sorted((r.doc_id, r.text) for r in docs.collect()))


def test_run(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = pieces.collect()
    assert rows and all(len(r.ids) == 4 * r.length for r in rows)
    total = Counter()
    for r in rows:
        total[r.sequence_id] += r.length
    assert max(total.values()) <= 4096
