"""What the lifecycle queries shuffle and keep: points and elements, not contributions."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import evidence as ev
from graphloom.operators import lifecycle as lc
from graphloom.operators import projection as pj
from graphloom.plans import fixtures as fx
from graphloom.plans import queries as Q

DIR = "/root/testdata/sf0.001"
ONCE = ["partial_expiry", "project_latest_per_element", "current_graph", "event_ids", "project_deletes", "project_vertices", "edge_endpoint_refs", "event_records", "project_edges", "upsert_events"]


def steps(df):
    """Steps of the plan, last one first."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line.lstrip(" :+-").split(" ")[0].split("(")[0] for line in text.split("\n")]


def after_extraction(df):
    """Shuffles of what is made of contributions: those above the lowest Generate (which makes contributions of points)."""
    found = steps(df)
    lowest = max(i for i, s in enumerate(found) if s == "Generate")
    return found[:lowest].count("Exchange")


def test_contributions_are_not_shuffled(spark):
    assert after_extraction(Q.contribution_latest(spark, DIR)) == 0


@pytest.mark.parametrize("name", ["attribute_winners", "expire_as_of", "delete_events"])
def test_winners_and_counts_shuffle_once(spark, name):
    df = Q.QUERIES[name](spark, DIR)
    assert after_extraction(df) == 1
    assert "Window" in steps(df)[1:]  # the newest points, before anything is extracted


@pytest.mark.parametrize("name", ONCE)
def test_elements_shuffle_once_and_are_not_kept(spark, name):
    df = Q.QUERIES[name](spark, DIR)
    local = [line for line in steps(df) if line == "InMemoryTableScan"]
    assert not local and steps(df).count("Generate") >= 2
    assert after_extraction(df) <= 1 + (name == "edge_endpoint_refs") * 3  # that one counts distinct ends besides


def test_newest_points_give_the_latest_contributions(spark):
    marked = ev.classify(fx.interaction_points(spark, DIR))
    marked = marked.unionByName(marked.where("point_id % 3 = 0").withColumns({"point_id": F.col("point_id") + 1, "observed_ns": F.col("observed_ns") + F.col("point_id") % 2 - 1}))
    kinds = ["service", "service.namespace", "app.endpoint"]
    columns = ["element_id", "contributor_id", "observed_ns", "point_id", "kind", "type", "source_id", "target_id", F.map_entries("attributes").alias("a")]
    want = lc.latest(ev.interactions(marked, types=kinds)).select(*columns).collect()
    got = ev.interactions(ev.newest(marked), types=kinds).select(*columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 1000


@pytest.mark.parametrize("within", [(), ("at",)])
def test_states_and_events_equal_the_separate_steps(spark, within):
    r = random.Random(5)
    rows = []
    for e in range(30):
        for c in range(r.randrange(1, 6)):
            a = {n: (r.choice("si"), str(r.randrange(3))) for n in "xyz" if r.random() < 0.5}
            rows.append((f"service:{e}", f"c{c}", r.randrange(1, 9), e, "node", "service", None, None, a, r.randrange(2)))
    schema = "element_id string, contributor_id string, observed_ns long, point_id long, kind string, type string, source_id string, target_id string, attributes map<string, struct<t: string, v: string>>, at int"
    dated = lc.deadlines(spark.createDataFrame(rows, schema), 3, 4, {}).withColumn("deadline_ns", F.greatest("observed_ns", F.lit(3)) + 4)
    live, lost = lc.expire_as_of(dated, 9)
    want = lc.upserts(lc.merge_attributes(dated)).withColumn("seq", F.lit(1)).unionByName(lc.upserts(lc.merge_attributes(live)).withColumn("seq", F.lit(2))).unionByName(lc.deletes(lost).withColumn("seq", F.lit(3)))
    found = lc.states(dated, 9, within)
    plain = lambda df: sorted(map(str, df.withColumn("attributes", F.map_entries("attributes")).collect()))
    assert plain(lc.events(found).select(*want.columns)) == plain(want)
    assert {x.seq for x in want.select("seq").distinct().collect()} == {1, 2, 3}
    counts = found.select("element_id", "expired_ns", "left").where("expired_ns IS NOT NULL")
    assert sorted(map(str, counts.collect())) == sorted(map(str, lost.select(*counts.columns).collect()))
    merged = lc.merge_attributes(dated, within).select("element_id", "contributors", "observed_ns", F.map_entries("attributes"))
    best = {}
    for e, c, at, _, _, _, _, _, a, _ in rows:
        for n, v in a.items():
            if (best.get((e, n)) or (99, "", ()))[:2] > (-at, c):
                best[e, n] = (-at, c, v)
    for e, contributors, at, a in merged.collect():
        mine = [x for x in rows if x[0] == e]
        assert (contributors, at) == (len(mine), max(x[2] for x in mine))
        assert {x.key: tuple(x.value) for x in a} == {n: best[f, n][2] for f, n in best if f == e}


@pytest.mark.parametrize("few", [0, 10_000])
def test_dangling_edges_are_found_without_a_shuffle_of_edges(spark, monkeypatch, few):
    monkeypatch.setattr(pj, "FEW", few)
    v = spark.createDataFrame([("a",), ("b",)], "element_id string")
    ends = [("a", "b"), ("a", "x"), ("y", "b"), ("x", "y"), ("b", "a"), (None, "a"), ("b", None)]
    e = spark.createDataFrame([(f"e{i}", s, t) for i, (s, t) in enumerate(ends)], "element_id string, source_id string, target_id string")
    found = pj.dangling_edges(v, e)
    assert sorted(x.element_id for x in found.collect()) == ["e1", "e2", "e3", "e5", "e6"]
    if few:
        assert not {"SortMergeJoin", "ShuffledHashJoin"} & set(steps(found)[: steps(found).index("InMemoryTableScan")])
