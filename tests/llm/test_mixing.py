import pytest

from corundum.llm import mixing


def test_shares_and_caps(spark):
    docs = [(i, "big", 10) for i in range(6000)] + [(10_000 + i, "small", 10) for i in range(300)] + [(20_000 + i, None, 10) for i in range(200)] + [(30_000, "other", 700), (30_001, "empty", 0)]
    sizes = spark.createDataFrame(docs, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("Big ", 0.5, 2), ("SMALL", 0.06, 4), ("patents", 0.1, 3), ("empty", 0.1, 3), ("big", 0.1, 1), (None, 0.3, 2), ("zero", None, None)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(sizes, targets).cache()
    rate = {r["source"]: r["rate"] for r in rated.collect()}
    total = sum(d[2] for d in docs)
    assert rate == pytest.approx({"big": 0.6 * total / 60_000, "small": min(4, 0.06 * total / 3000), "patents": 0.0, "empty": 0.0, "zero": 0.0})
    mixed = mixing.mixture(sizes, rated).cache()
    assert mixed.filter("source not in ('big', 'small') or source is null").count() == 0
    assert mixed.groupBy("doc_id").count().filter("count > 4").count() == 0
    got = {r["source"]: r for r in mixing.reached(mixed, rated).collect()}
    assert got["big"]["reached_share"] == pytest.approx(0.6, abs=0.02) and got["small"]["reached_share"] == pytest.approx(0.06, abs=0.006)
    assert not got["patents"]["met"] and sum(r["mix_share"] for r in got.values()) == pytest.approx(1.0)
    again = mixing.mixture(sizes.repartition(9), rated)
    assert sorted(map(tuple, again.select("doc_id", "copy_no").collect())) == sorted(map(tuple, mixed.select("doc_id", "copy_no").collect()))


def test_a_capped_source_is_used_fully(spark):
    sizes = spark.createDataFrame([(i, "a", 1) for i in range(10)] + [(100 + i, "b", 99) for i in range(10)], "doc_id bigint, source string, n_tokens bigint")
    rated = mixing.rates(sizes, spark.createDataFrame([("a", 0.9, 3)], "source string, target_share double, max_repeats int"))
    assert mixing.mixture(sizes, rated).count() == 30
    assert not mixing.reached(mixing.mixture(sizes, rated), rated).first()["met"]


def test_empty_tables(spark):
    sizes = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 2)], "source string, target_share double, max_repeats int")
    rated = mixing.rates(sizes, targets)
    assert rated.first()["rate"] == 0 and mixing.mixture(sizes, rated).count() == 0 and mixing.reached(mixing.mixture(sizes, rated), rated).first()["reached_share"] == 0
    assert mixing.rates(sizes, targets.limit(0)).count() == 0
