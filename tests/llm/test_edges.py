"""Every operator on documents takes nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import gam, langid, lm, mixing, packing, repetition, simhash
from tests.llm.helpers import CLASHES, LONG, ODD, no_docs, odd_docs

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (5, 1)], "doc_id long, quality int")


PER_ROW = {
    "repetition": lambda spark, d: repetition.repetition_report(d),
    "simhash": lambda spark, d: simhash.near_duplicates(d),
    "mix": lambda spark, d: mixing.mix(d, block_docs=2, round_slots=8, group_rows=4),
    "gam": lambda spark, d: gam.score(d, gam.train(d, labels(spark))),
    "langid": lambda spark, d: langid.identify(d, langid.train(d)),
    "lm": lambda spark, d: lm.score(d, F.col("doc_id") == 6),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_each(spark, name):
    out = PER_ROW[name](spark, odd_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in ODD)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(spark, name):
    assert PER_ROW[name](spark, no_docs(spark)).count() == 0


KEEPING = {
    "gam": lambda spark, d: gam.keep_good(d, gam.train(d, labels(spark))),
    "langid": lambda spark, d: langid.keep_known(d, langid.train(d)),
    "copies": lambda spark, d: simhash.one_of_each_group(d),
    "order": lambda spark, d: mixing.in_mixed_order(d, block_docs=2, round_slots=8, group_rows=4),
}


@pytest.mark.parametrize("name", KEEPING)
def test_stages_keep_columns(spark, name):
    docs = odd_docs(spark)
    out = KEEPING[name](spark, docs)
    assert out.dtypes == docs.dtypes
    rows = out.collect()
    assert rows and {r[CLASHES[0]] for r in rows} == {"id0"}
    assert KEEPING[name](spark, no_docs(spark)).collect() == []
    if name == "order":
        assert sorted(map(str, rows)) == sorted(map(str, docs.collect()))
    if name == "copies":  # equal texts once, the null text with the empty one; the smallest id stays
        assert sorted(str(r.doc_id) for r in rows) == sorted(["1", "2", "None", "4", "5", "6", "7", "8", "10"])
    if name == "langid":
        assert {r.doc_id for r in rows} <= {1, None, 5, 6, 7, 8, 9, 10}


def test_packing(spark):
    out = packing.pack_documents(odd_docs(spark), TOKENS).collect()
    whole = {}
    for r in out:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole[2] == 1 and whole[3] == 1 and whole[5] > 60_000 and len(LONG) > 400_000
    assert packing.pack_documents(no_docs(spark), TOKENS).collect() == []


def test_values_of_odd_rows(spark):
    rows = {r.doc_id: r for r in repetition.repetition_report(odd_docs(spark)).where("doc_id is not null").collect()}
    assert rows[3].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[7].n_words == 2 and rows[7].n_dup_lines == 0
    assert rows[8].n_repeat_words == 4
    prints = {r.doc_id: r for r in simhash.near_duplicates(odd_docs(spark)).where("doc_id is not null").collect()}
    assert prints[2].fingerprint == prints[3].fingerprint == "0" * 16 and prints[3].component_id == 2
    assert prints[9].component_id == 8
    langs = {r.doc_id: r for r in langid.identify(odd_docs(spark), langid.train(odd_docs(spark))).where("doc_id is not null").collect()}
    assert [langs[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and langs[4].score == 0
    model = gam.train(odd_docs(spark), labels(spark))
    scores = {r.doc_id: r for r in gam.score(odd_docs(spark), model).where("doc_id is not null").collect()}
    assert scores[2].score == scores[3].score and all(0 <= r.score <= 1 for r in scores.values())
    costs = {r.doc_id: r for r in lm.score(odd_docs(spark), F.col("doc_id") == 6).where("doc_id is not null").collect()}
    assert costs[3].n_tokens == 1 and costs[3].bits_per_byte is None and costs[6].held_out and costs[5].score < 0
