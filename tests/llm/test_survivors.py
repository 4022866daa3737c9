import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from corundum.llm import survivors

FIELDS = ["a", "b", "c"]


def layers_of(spark, rows):
    df = spark.createDataFrame(rows, "key string, row_seq bigint, trust int, at timestamp, a double, b double, c string, tie int")
    usable = {"a": survivors.finite(F.col("a")), "b": survivors.finite(F.col("b")), "c": survivors.not_blank(F.col("c"))}
    return survivors.skyline_layers(survivors.representatives(df.withColumnRenamed("tie", "extra"), "key", usable, F.col("trust"), "at", "row_seq"))


def test_suppliers_equal_a_sort_by_field(spark):
    rng = random.Random(9)
    t0 = datetime(2024, 1, 1)
    num = lambda: rng.choice([None, float("nan"), float("inf"), 1.5, rng.random()])
    rows = [(rng.choice(["hot", "hot", "k1", "k2", "k3", None]), i, rng.randrange(5), rng.choice([None, t0 + timedelta(days=rng.randrange(4))]), num(), num(), rng.choice([None, "", " \t", "v"]), 0) for i in range(300)]
    layers = layers_of(spark, rows).cache()
    got = {(r["group_id"], r["field_name"]): (r["tie"], r["layer"]) for r in survivors.suppliers(layers, FIELDS).collect()}
    good = lambda v: v is not None and (bool(v.strip()) if isinstance(v, str) else v == v and abs(v) != float("inf"))
    want = {}
    for k in {r[0] for r in rows} - {None}:
        for j, f in enumerate(FIELDS):
            own = [r for r in rows if r[0] == k and good(r[4 + j])]
            if own:
                want[k, f] = min(own, key=lambda r: (r[2], -(r[3].timestamp() if r[3] else -1e18), r[1]))[1]
    assert {k: v[0] for k, v in got.items()} == want
    # Fields are compared as a set, so that the best supplier of each is never dominated.
    assert {v[1] for v in got.values()} == {1}
    assert {r["group_id"]: r["n"] for r in layers.collect()} == {k: sum(r[0] == k for r in rows) for k in ("hot", "k1", "k2", "k3")}
    assert max(len(r["ranked"]) for r in layers.collect()) <= 2 ** len(FIELDS) * 5


def test_layers_peel(spark):
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("k", 1, 0, t[2], 1.0, 1.0, "x", 0), ("k", 2, 1, t[2], 1.0, 1.0, None, 0), ("k", 3, 2, t[1], 1.0, None, None, 0), ("k", 4, 3, t[0], 2.0, None, "y", 0)]
    (r,) = layers_of(spark, rows).collect()
    assert {x["tie"]: x["layer"] for x in r["ranked"]} == {1: 1, 2: 2, 3: 3, 4: 2}


def test_built_record(spark):
    t = datetime(2024, 1, 1)
    layers = layers_of(spark, [("k", 1, 0, t, None, 5.0, None, 0), ("k", 2, 1, t, 7.0, 6.0, "  ", 0), ("lone", 3, 0, None, None, None, None, 0)])
    got = {r["group_id"]: r for r in survivors.survivors(layers, FIELDS).collect()}
    assert (got["k"]["base"], got["k"]["a"], got["k"]["b"], got["k"]["c"], got["k"]["filled_from_others"]) == (1, 7.0, 5.0, None, 1)
    assert got["lone"]["n"] == 1 and got["lone"]["a"] is None and got["lone"]["filled_from_others"] == 0
    assert layers_of(spark, [("k", 1, 0, t, 1.0, 1.0, "x", 0)]).filter("n > 1").count() == 0


def test_layers_act_where_completeness_is_a_count(spark):
    # The first by policy has two fields; the second has one, which the first lacks; by count it is dominated.
    rows = [(1, "g", 1.0, 2.0, None, 0, "2024-02-01"), (2, "g", None, None, 9.0, 0, "2024-01-01"), (3, "g", None, None, 7.0, 1, "2024-03-01")]
    df = spark.createDataFrame(rows, "id bigint, g string, a double, b double, c double, trust int, at string").withColumn("at", F.col("at").cast("timestamp"))
    reps = survivors.representatives(df, "g", {f: survivors.finite(F.col(f)) for f in "abc"}, F.col("trust"), "at", "id")
    layer = lambda kind: {r["tie"]: r["layer"] for r in survivors.skyline_layers(reps, kind).select(F.explode("ranked").alias("x")).select("x.*").collect()}
    assert layer("set") == {1: 1, 2: 1, 3: 1} and layer("count") == {1: 1, 2: 2, 3: 1}
    got = {k: {r["field_name"]: (r["tie"], r["layer"]) for r in survivors.suppliers(survivors.skyline_layers(reps, k), list("abc")).collect()} for k in ("set", "count")}
    assert got["set"]["c"] == (2, 1) and got["count"]["c"] == (3, 1)
