"""Exploded tables are never broadcast, however small Spark takes them for."""

import re

import corpus_pipeline
import pytest

from cohort_spark.llm import components, minhash_dedup


def _broadcast_subtrees(plan: str):
    """The text of each BroadcastExchange's subtree in a printed plan."""
    lines = plan.split("\n")
    depth = [len(re.match(r"[\s:|+*()\d-]*", x).group()) for x in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield "\n".join(lines[i:end])


@pytest.mark.parametrize("pipeline", [False, True])
def test_near_dedup_broadcasts_no_exploded_rows(spark, monkeypatch, pipeline):
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stage(df, name)

    stage = minhash_dedup.stage
    monkeypatch.setattr(minhash_dedup, "stage", kept)
    monkeypatch.setattr(components, "stage", kept)
    text = [" ".join([*(f"w{g}x{i}" for i in range(60)), f"end{v}"]) for g in range(30) for v in range(8)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    if pipeline:
        assert corpus_pipeline.near_dedup(spark, docs, "").count() == 30
    else:
        rows = minhash_dedup.minhash_dedup(docs, percent=80, rows=2).collect()
        assert len(rows) == len(text) and len({r["component_id"] for r in rows}) == 30
    by_name = {n: p for n, p in plans}
    assert "BroadcastHashJoin" not in by_name["minhash-buckets"] and "SortMergeJoin" in by_name["minhash-buckets"]
    assert "BroadcastHashJoin" not in by_name["minhash-links"]
    compared = [p for _, p in plans if "FlatMapGroupsInPandas" in p]
    assert compared
    for plan in compared + [by_name["minhash-buckets"], by_name["minhash-links"]]:
        assert not any("Generate" in x for x in _broadcast_subtrees(plan)), plan
