import random
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.operators.components import components, parents


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def run(spark, pairs, parts=3, **options):
    edges = spark.createDataFrame(pairs, "src string, dst string").repartition(parts)
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return {r["id"]: r["component"] for r in components(vertices, edges, **options).collect()}


@pytest.mark.parametrize(
    "pairs",
    [
        [("a", "b")],
        [("b", "a"), ("a", "b"), ("a", "a")],
        [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a"), ("x", "y")],
        [("z", f"n{i}") for i in range(40)],
        [("a", f"n{i}") for i in range(40)],
    ],
    ids=["edge", "copies-and-loop", "cycle", "star-high-hub", "star-low-hub"],
)
def test_small_shapes(spark, pairs):
    assert run(spark, pairs) == union_find(pairs)


def test_vertices_without_edges_are_their_own_component(spark):
    vertices = spark.createDataFrame([("a",), ("b",)], "id string")
    edges = spark.createDataFrame([], "src string, dst string")
    assert {tuple(r) for r in components(vertices, edges).collect()} == {("a", "a"), ("b", "b")}


def test_long_path_with_shuffled_labels(spark):
    labels = [f"{i:05d}" for i in range(1001)]
    random.Random(7).shuffle(labels)
    pairs = list(zip(labels, labels[1:]))
    assert run(spark, pairs) == union_find(pairs)


@pytest.mark.parametrize("hub", ["0", "zzz"])
def test_hub_with_many_leaves_is_spread(spark, hub):
    leaves = [(hub, f"{i:06d}") for i in range(100_000)]
    got = run(spark, leaves, rows_per_task=1_000)
    assert len(got) == 100_001 and set(got.values()) == {min(hub, "000000")}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=40),
    st.integers(1, 5),
)
def test_any_graph_any_partitioning(spark, numbers, parts):
    pairs = [(f"v{a}", f"v{b}") for a, b in numbers]
    assert run(spark, pairs, parts, rows_per_task=3) == union_find(pairs)


def test_rounds_aggregate_integers_in_hash_tables(spark, scratch):
    edges = spark.range(50).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    plans = []
    keep = scratch.keep
    scratch.keep = lambda df, name, **options: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df, name, **options)
    found = {r["id"]: r["component"] for r in parents(edges, scratch).collect()}
    assert found == {i: 0 for i in range(1, 51)}
    assert any("HashAggregate" in p for p in plans) and not any("SortAggregate" in p for p in plans)


def test_rounds_on_a_path_shrink(spark, scratch):
    """What all rounds write together is a few times the input, not a number of rounds times."""
    labels = list(range(3_000))
    random.Random(3).shuffle(labels)
    edges = spark.createDataFrame(list(zip(labels, labels[1:])), "src long, dst long")
    written = {}
    keep = scratch.keep

    def counted(df, name, **options):
        kept = keep(df, name, **options)
        written[name] = kept.count()
        return kept

    scratch.keep = counted
    found = {r["id"]: r["component"] for r in parents(edges, scratch).collect()}
    assert found == {i: 0 for i in range(1, 3_000)}
    assert sum(n for name, n in written.items() if name.startswith("edges-")) < 2 * 3_000
    assert sum(written.values()) < 8 * 3_000


def test_keys_whose_hashes_are_alike_stay_apart(spark, monkeypatch):
    module = sys.modules["citeloom.operators.components"]
    monkeypatch.setattr(module, "_label", lambda key: F.pmod(F.xxhash64(key), F.lit(3)))
    pairs = [("a", "b"), ("c", "d"), ("d", "e"), ("x", "y"), ("p", "q"), ("q", "q")]
    assert run(spark, pairs, rows_per_task=2) == union_find(pairs)


def test_edges_get_their_numbers_without_a_dictionary(spark, scratch, monkeypatch):
    module = sys.modules["citeloom.operators.components"]
    monkeypatch.setattr(module, "numbered_edges", lambda *a: pytest.fail("edges were joined to the keys"))
    edges = spark.createDataFrame([(f"a{i}", f"b{i % 7}") for i in range(60)], "src string, dst string")
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    assert components(vertices, edges, scratch).count() == 67


def test_edges_to_no_vertex_are_left_out(spark):
    vertices = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    edges = spark.createDataFrame([("a", "x"), ("x", "b"), ("c", "d"), (None, "a"), (None, "b")], "src string, dst string")
    got = {r["id"]: r["component"] for r in components(vertices, edges).collect()}
    assert got == {"a": "a", "b": "b", "c": "c", "d": "c"}
