import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corundum.llm import queries, splits


def union_find(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        root[rb] = ra
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(f"n{rng.randrange(60):03d}", f"n{rng.randrange(60):03d}") for _ in range(35)]
    edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(12)]  # a path
    edges += [("hub", f"s{i:03d}") for i in range(80)]  # a hub with most of the edges
    edges += edges[:20] + [("n001", "n001")]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in splits.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == union_find([e for e in edges if e[0] != e[1]], nodes)


def test_records_sharing_any_entity(spark):
    rows = [(1, "a", None), (2, "a", "x"), (3, None, "x"), (4, "b", None), (5, None, None), (6, None, None), (7, "c", "y"), (8, "d", "y"), (8, "d", "y")]
    df = spark.createDataFrame(rows, "row_seq bigint, author string, source string").withColumn("_first", F.lit(1))
    entities = {"author": F.col("author"), "source": F.col("source")}
    got = {r["row_seq"]: r["component_id"] for r in splits.with_components(df, entities, "row_seq").collect()}
    assert got[1] == got[2] == got[3] and got[7] == got[8] and len({got[i] for i in (1, 4, 5, 6, 7)}) == 5
    assert got[5] == "row:5"
    assert splits.with_components(df.limit(0), entities, "row_seq").count() == 0


@pytest.mark.parametrize("giant", [0, 1000, 3000])
def test_shares_with_a_giant_component(spark, giant):
    rows = [(i, "giant" if i < giant else f"c{i // 3}") for i in range(9000)]
    df = spark.createDataFrame(rows, "row_seq bigint, component_id string")
    done = splits.assign_splits(df, {"train": 0.8, "validation": 0.1, "test": 0.1}).cache()
    share = {r["split_name"]: r["n"] / 9000 for r in done.groupBy("split_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert share == pytest.approx({"train": 0.8, "validation": 0.1, "test": 0.1}, abs=0.02)
    assert done.groupBy("component_id").agg(F.count_distinct("split_name").alias("k")).filter("k > 1").count() == 0
    again = splits.assign_splits(df.repartition(7), {"test": 0.1, "train": 0.8, "validation": 0.1})
    assert sorted(map(tuple, again.select("row_seq", "split_name").collect())) == sorted(map(tuple, done.select("row_seq", "split_name").collect()))


def test_split_edges(spark):
    df = spark.createDataFrame([(1, "a")], "row_seq bigint, component_id string")
    assert splits.assign_splits(df, {"all": 2.0, "none": 0.0, "null": None}).first()["split_name"] == "all"
    assert splits.assign_splits(df.limit(0), {"a": 1.0}).count() == 0
    with pytest.raises(ValueError):
        splits.assign_splits(df, {"a": 0.0})


def test_grouped_records(spark):
    df = spark.createDataFrame([(1, "c", "k"), (2, "c", "k"), (3, "c", "l"), (4, "d", None), (5, "d", None)], "row_seq bigint, component_id string, compound_id string")
    assert sorted(r["row_seq"] for r in splits.grouped_records(df, "component_id", "compound_id").collect()) == [1, 2]


def test_one_compound_by_either_spelling(spark, tmp_path):
    smiles = ["CCO", "CCN", "CCC"]
    hexes = [hashlib.md5(x.encode()).hexdigest() for x in smiles]
    # The first compound has one record by CompoundID only and one by SMILES only, the third one record alone.
    rows = [(1, hexes[0].upper(), None), (2, None, smiles[0]), (3, hexes[1], smiles[1]), (4, "?", smiles[1]), (5, hexes[2], None), (6, None, None)]
    spark.createDataFrame(rows, "row_seq bigint, CompoundID string, CanonicalSMILES string").write.parquet(f"{tmp_path}/batch.parquet")
    spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split_name string, share double").write.parquet(f"{tmp_path}/split_targets.parquet")
    found = sorted(map(tuple, queries.p1_found(spark, str(tmp_path)).collect()))
    assert found == [(1, hexes[0]), (2, hexes[0]), (3, hexes[1]), (4, hexes[1])]
    got = {r["row_seq"]: (r["component_id"], r["split_name"]) for r in queries.p1_splits(spark, str(tmp_path)).collect()}
    assert got[1] == got[2] and got[3] == got[4] and len({got[i][0] for i in (1, 3, 5, 6)}) == 4
    assert queries.p1_shares(spark, str(tmp_path)).agg(F.sum("components")).first()[0] == 4


def test_a_kept_plan_moves_no_component(spark):
    rows = [(i, f"c{i // 2}") for i in range(600)]
    df = spark.createDataFrame(rows, "row_seq bigint, component_id string")
    targets = {"train": 0.8, "test": 0.2}
    plan = splits.SplitPlan.from_json(splits.plan_splits(df, targets).to_json())
    before = {r["component_id"]: r["split_name"] for r in splits.assign_splits(df, targets, plan=plan).collect()}
    # A component of a third of all rows arrives later, and an old one grows.
    more = df.unionByName(spark.createDataFrame([(1000 + i, "big" if i % 2 else "c7") for i in range(600)], df.schema))
    after = {r["component_id"]: r["split_name"] for r in splits.assign_splits(more, targets, plan=plan).collect()}
    assert {c: after[c] for c in before} == before
    with pytest.raises(ValueError):
        splits.SplitPlan.from_json(plan.to_json().replace('"version": 1', '"version": 0'))


@pytest.mark.parametrize("sizes", [(3000,), (2000, 2000), (900, 900, 900)])
def test_one_rule_for_components_of_any_size(spark, sizes):
    rows = [f"big{k}" for k, n in enumerate(sizes) for _ in range(n)]
    rows += [f"c{i // 3}" for i in range(9000 - len(rows))]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(rows)], "row_seq bigint, component_id string")
    share = {r["split_name"]: r["n"] / 9000 for r in splits.assign_splits(df, {"train": 0.8, "validation": 0.1, "test": 0.1}).groupBy("split_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert share == pytest.approx({"train": 0.8, "validation": 0.1, "test": 0.1}, abs=0.01)
