import numpy as np
import pytest
from pyspark.sql import functions as F

from corundum.llm import digests as D

RNG = np.random.default_rng(7)
SAMPLES = {
    "normal": RNG.normal(size=40_000), "heavy": RNG.standard_cauchy(30_000), "integers": RNG.integers(0, 40, 30_000).astype(float), "constant": np.full(999, 3.5),
    "two": np.array([1.0, 2.0]), "one": np.array([-7.0]), "sorted": np.arange(50_000.0), "spike": np.r_[np.zeros(20_000), RNG.normal(size=10_000)], "log": RNG.lognormal(0, 4, 20_000),
}


def digest(values):
    return D.cluster(values, np.ones(len(values), np.int64), values, values)


def rank_error(values, estimate, q):
    s = np.sort(values)
    return max(np.searchsorted(s, estimate) / len(s) - q, q - np.searchsorted(s, estimate, "right") / len(s), 0)


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("parts", [1, 37])
def test_rank_errors_after_merging(name, parts):
    values = SAMPLES[name]
    pieces = [digest(p) for p in np.array_split(values, parts) if len(p)]
    made = D.cluster(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
    assert made[1].sum() == len(values) and len(made[0]) < 2 * D.DELTA
    got = D.quantiles(*made, D.PERCENTILES)
    assert (np.diff(got) >= 0).all() and got.min() >= values.min() and got.max() <= values.max()
    assert max(rank_error(values, e, q) for e, q in zip(got, D.PERCENTILES, strict=True)) <= D.RANK_BOUND


def test_certified_percentiles(spark):
    rows = [("a", float(v), int(abs(v) * 5)) for v in RNG.normal(size=3000)] + [(None, 1.0, 2), ("b", float("nan"), None), ("b", float("inf"), None), ("c", 5.0, 1), ("c", None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, n int").withColumn("estimates", F.lit(0)).repartition(6)
    got = D.percentiles(df, {"g": F.col("g"), "all": F.lit("all")}, ["x", "n"]).collect()
    assert all(r["certified"] for r in got)
    keys = {(r["grouping"], r["group_key"], r["metric"]): r["n"] for r in got}
    assert keys == {("g", "a", "x"): 3000, ("g", "a", "n"): 3000, ("g", None, "x"): 1, ("g", None, "n"): 1, ("g", "c", "x"): 1, ("g", "c", "n"): 2, ("all", "all", "x"): 3002, ("all", "all", "n"): 3003}
    values = np.array([r[1] for r in rows if r[0] == "a"])
    for r in got:
        if (r["group_key"], r["metric"]) == ("a", "x"):
            assert r["rows_below"] == (values < r["estimate"]).sum() and r["rows_upto"] == (values <= r["estimate"]).sum()
            assert r["rank_error"] == pytest.approx(rank_error(values, r["estimate"], r["share"]), abs=1e-12)
    assert D.percentiles(df.limit(0), {"g": F.col("g")}, ["x"]).count() == 0


def test_a_failed_certificate_is_not_hidden(spark):
    df = spark.createDataFrame([(float(v),) for v in RNG.normal(size=5000)], "x double")
    coarse = D.percentiles(df, {"all": F.lit("a")}, ["x"], bound=1e-9, delta=8.0, tries=1)
    assert coarse.filter("not certified").count() > 0


def test_days_merge_into_months(spark):
    df = spark.createDataFrame([(f"2024-0{1 + i % 2}-{1 + i % 20:02d}", float(v)) for i, v in enumerate(RNG.normal(size=8000))], "day string, x double").repartition(5)
    days = D.digests(df, {"day": F.col("day")}, ["x"])
    months = D.estimates(D.merge_digests(days.withColumn("group_key", F.substring("group_key", 1, 7)), list(D.KEYS)))
    for r in months.collect():
        values = np.array([x["x"] for x in df.filter(F.col("day").startswith(r["group_key"])).collect()])
        assert r["n"] == len(values) and max(rank_error(values, e, q) for e, q in zip(r["estimates"], D.PERCENTILES, strict=True)) <= D.RANK_BOUND


def test_digests_of_many_partitions_merge_level_by_level(spark, monkeypatch):
    from pyspark.sql import functions as F

    from corundum.llm import digests as D

    monkeypatch.setattr(D, "_FAN_IN", 2)
    df = spark.range(0, 9000, 1, 9).select((F.col("id") % 2).alias("k"), F.pow(F.col("id").cast("double"), 1.5).alias("v"))
    made = D.digests(df, {"k": F.col("k")}, ["v"])
    assert made.count() == 2 and {sum(r["weights"]) for r in made.collect()} == {4500}
    assert all(r["certified"] for r in D.percentiles(df, {"k": F.col("k")}, ["v"]).collect())


def test_months_from_days_are_certified(spark):
    from corundum.llm import queries

    got = queries.p3_merged_months(spark, "/root/testdata/sf0.001").collect()
    assert got and all(r["certified"] and r["rank_error"] <= 0.01 for r in got)
