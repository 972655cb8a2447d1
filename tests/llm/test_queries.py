"""Registered queries against their check SQL on the smallest tables, against brute force, and the pipeline's stages."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from hazegrid.llm.common import keep, table
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("key", ["op1_mixing", "op5_repetition", "op6_warc", "op8_chat", "op11_importance", "op12_topk", "op13_manifest"])
def test_against_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    mine, theirs = compare(entry.queries()[key](spark, FOLDER), con, entry.oracle_sql()[key])
    assert mine and mine == theirs


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    start, columns = {r.doc_id: r for r in docs.collect()}, docs.columns
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        out = stage(spark, docs, FOLDER)
        if number == len(corpus_pipeline.STAGES) - 1:
            assert {r.doc_id for r in out.collect()} == before
            break
        assert out.columns == columns
        rows = out.collect()
        after = {r.doc_id for r in rows}
        assert after <= before and len(after) == len(rows) and all(tuple(r) == tuple(start[r.doc_id]) for r in rows)
        if name == "quality classifier":
            good = [i for i, q in labels.items() if q == 1]
            assert sum(i in after for i in good) > 0.97 * len(good)
            assert sum(i in after for i, q in labels.items() if q == 0) < 0.1 * len(labels)
        if name == "mixing sources":
            assert after == before
        docs = keep(out, "stage")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "mixing sources", "best-fit packing"]
