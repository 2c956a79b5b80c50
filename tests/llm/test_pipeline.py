"""The pipeline's stages against brute force, and the registered SQL."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fleetreports.llm import mixing
from tests.llm.conftest import SMALL
from tests.llm.test_operators import near_by_hand


@pytest.mark.parametrize("name", ["op1_url_rules", "op2_near_dedup", "op6_mixing", "op7_substring_dedup", "op8_secret_scan",
                                  "op11_vector_codes", "op12_hard_negatives", "op13_jaccard_join"])
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    out = entry.queries()[name](spark, SMALL)
    cols = sorted(out.columns)
    want = con.execute(entry.oracle_sql()[name])
    at = [[d[0] for d in want.description].index(c) for c in cols]
    assert sorted([d[0] for d in want.description]) == cols
    assert sorted(repr([r[i] for i in at]) for r in want.fetchall()) == sorted(repr([r[c] for c in cols]) for r in out.collect())


def test_stages(spark, docs):
    """Rejected: no letter or no text; then copies; then benchmark passages."""
    kept = docs
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SMALL).cache()
        left[name] = kept.collect()
        if name != "shard":
            assert kept.columns == before.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "shard"]
    given = {r.doc_id for r in docs.collect() if r.doc_id is not None and r.doc_id < 10_000}
    assert given <= {r.doc_id for r in left["language_id"]}
    _, label = near_by_hand([(r.doc_id, r.text) for r in left["language_id"]])
    assert {r.doc_id for r in left["near_dedup"] if r.doc_id is not None} == set(label.values())
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {r.doc_id for r in left["near_dedup"] if not any(i in r.text for i in items)}
    assert {r.doc_id for r in left["decontaminate"]} == want
    assert {r.doc_id for r in left["mix"]} <= want
    assert len(left["mix"]) == mixing.mix(spark.createDataFrame(left["decontaminate"], docs.schema)).count() == len(left["shard"])


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 100
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_nothing_in(spark, none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0
