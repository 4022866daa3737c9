"""References to records that do not exist, are deleted or arrive later.

Parent keys are sorted integers. They are compressed into contiguous runs (start, end) and each reference is matched
as-of to the preceding run start; a key beyond that run's end has no parent. Runs and references are laid out by
buckets of 2**BUCKET_BITS neighbouring keys: a run never crosses a bucket, so a bucket is worked out alone, holds a
bounded number of distinct keys, and no key can be hot, as references are reduced to distinct ones first.

Whether a parent is live when a reference arrives is an as-of match too, on time: the latest deletion among the
parent rows loaded so far, carried over days, so that a key with very many deliveries is spread over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corundum.functions.ids import zinc_name, zinc_number
from corundum.session import materialise, salted_join

BUCKET_BITS = 16
NEVER = "9999-12-31 00:00:00"


def _bucket(key: Column) -> Column:
    return F.shiftright(key, BUCKET_BITS)


def key_runs(parents: DataFrame, key: str) -> DataFrame:
    """Runs of contiguous keys: bucket, run_start, run_end. Null keys are no parents."""
    keys = parents.select(F.col(key).alias("k")).filter("k is not null").distinct().withColumn("bucket", _bucket(F.col("k")))
    order = W.partitionBy("bucket").orderBy("k")
    island = F.col("k") - F.row_number().over(order)
    return keys.withColumn("_island", island).groupBy("bucket", "_island").agg(F.min("k").alias("run_start"), F.max("k").alias("run_end")).drop("_island")


def match_runs(refs: DataFrame, key: str, runs: DataFrame) -> DataFrame:
    """Distinct reference keys with `present`: whether the preceding run start's run reaches the key."""
    asked = refs.select(F.col(key).alias("k")).filter("k is not null").distinct()
    null = F.lit(None).cast("bigint")
    both = runs.select("bucket", F.col("run_start").alias("k"), F.lit(0).alias("side"), "run_end").unionByName(
        asked.select(_bucket(F.col("k")).alias("bucket"), "k", F.lit(1).alias("side"), null.alias("run_end"))
    )
    preceding = W.partitionBy("bucket").orderBy("k", "side").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.last("run_end", ignorenulls=True).over(preceding)
    return both.withColumn("_end", end).filter("side = 1").select(F.col("k").alias(key), F.coalesce(F.col("k") <= F.col("_end"), F.lit(False)).alias("present"))


def live_as_of(refs: DataFrame, parents: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """References (key, at, other columns) with `known` (a parent row starts by then) and `live`.

    live: some parent row with start <= at ends after `at`, or never. Worked out as the running maximum of the ends,
    first within each day of each key, then carried over the days before it. A parent row without start counts from
    the beginning; a reference without time matches nothing: known and live are then null.
    """
    far = F.lit(NEVER).cast("timestamp_ntz")
    early = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    t = lambda c: F.col(c).cast("timestamp_ntz")
    begun = parents.filter(F.col(key).isNotNull()).groupBy(key, F.coalesce(t(start), early).alias("_t")).agg(F.max(F.coalesce(t(end), far)).alias("_end"))
    begun = begun.withColumn("_day", F.to_date("_t"))
    days = begun.groupBy(key, "_day").agg(F.max("_end").alias("_dayend"))

    asked = refs.withColumns({"_t": t(at), "_day": F.to_date(t(at))})
    ref_days = asked.filter(F.col("_t").isNotNull()).select(key, "_day").distinct().withColumn("_dayend", F.lit(None).cast("timestamp_ntz"))
    # One row for each key and day: bounded by the calendar, however many rows a key has.
    before = W.partitionBy(key).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        days.unionByName(ref_days).groupBy(key, "_day").agg(F.max("_dayend").alias("_dayend"))
        .withColumn("_carry", F.max("_dayend").over(before)).filter("_carry is not null")
    )
    # The carried deletion enters its day as an event at the day's first moment, in front of all others.
    events = (
        begun.select(key, "_day", "_t", F.lit(1).alias("_side"), "_end")
        .unionByName(carried.select(key, "_day", F.col("_day").cast("timestamp_ntz").alias("_t"), F.lit(0).alias("_side"), F.col("_carry").alias("_end")))
        .unionByName(asked.withColumns({"_side": F.lit(2), "_end": F.lit(None).cast("timestamp_ntz")}), allowMissingColumns=True)
    )
    sofar = W.partitionBy(key, "_day").orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    latest = F.max("_end").over(sofar)
    timed = F.col("_t").isNotNull()
    return (
        events.withColumn("_latest", latest).filter("_side = 2")
        .withColumns({"known": F.when(timed, F.col("_latest").isNotNull()), "live": F.when(timed, F.coalesce(F.col("_latest") > F.col("_t"), F.lit(False)))})
        .select(*refs.columns, "known", "live")
    )


def _keyed(df: DataFrame, id_col: str, *others: str) -> DataFrame:
    """Distinct key (the number of a ZINC id, null for other ids), zinc_id (the id's one text) and `others`.

    Distinct spellings first: a delivery repeats its id for every atom, and the spelling rules run once for each.
    """
    few = df.select(F.col(id_col).alias("_id"), *others).distinct()
    few = few.select(zinc_number(F.col("_id")).alias("key"), zinc_name(F.col("_id")).alias("zinc_id"), *others)
    return few.filter("zinc_id is not null").distinct()


def _present(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """zinc_id, present, __rows of the references' distinct ids: numbers by their parents' runs, other ids by their text."""
    rows = refs.groupBy("key", "zinc_id").agg(F.count(F.lit(1)).alias("__rows"))
    numbers = match_runs(rows, "key", key_runs(parents, "key"))
    theirs = parents.filter("key is null").select("zinc_id").distinct().withColumn("__is", F.lit(True))
    others = rows.filter("key is null").join(theirs, "zinc_id", "left").select("zinc_id", F.coalesce("__is", F.lit(False)).alias("present"), "__rows")
    return rows.join(numbers, "key").select("zinc_id", "present", "__rows").unionByName(others)


def orphan_references(main: DataFrame, children: dict[str, DataFrame], id_col: str = "Zinc_id", complete: tuple[str, ...] = ("xyz",)) -> DataFrame:
    """table_name, zinc_id, period, kind: distinct orphan references by table and month.

    children: rows that refer to main by id and loaded_at. A case is `missing` if main never has the molecule, `late`
    if all its rows are loaded after the reference, else `deleted`. Each main molecule without any row in a table of
    `complete` is a case of table `main`, `missing`. Null and blank ids are no references. A reference without
    loaded_at is only ever judged `missing`, with a null period. Repeated rows and ties change nothing; empty parents
    make every reference missing. Extra columns are not read.
    """
    # Distinct deliveries are a small part of the children's rows and are read several times below, so they are written once.
    parents = materialise(_keyed(main, id_col, "loaded_at", "deleted_at"))
    refs = None
    for name, child in children.items():
        part = _keyed(child, id_col, "loaded_at").withColumn("table_name", F.lit(name))
        refs = part if refs is None else refs.unionByName(part)
    assert refs is not None
    refs = materialise(refs)
    month = lambda c: F.date_format(c, "yyyy-MM").alias("period")
    known = salted_join(refs, _present(refs, parents), ["zinc_id"], "inner", weight="__rows")
    judged = live_as_of(known, parents, "zinc_id", "loaded_at", "loaded_at", "deleted_at")
    kind = F.when(~F.col("present"), "missing").when(F.col("live"), None).when(F.col("known"), "deleted").when(~F.col("known"), "late")
    out = judged.withColumn("kind", kind).filter("kind is not null").select("table_name", "zinc_id", month("loaded_at"), "kind")
    for name in complete:
        lone = _present(parents, refs.filter(F.col("table_name") == name)).filter("not present")
        met = salted_join(parents, lone.drop("present"), ["zinc_id"], "inner", weight="__rows")
        out = out.unionByName(met.select(F.lit("main").alias("table_name"), "zinc_id", month("loaded_at"), F.lit("missing").alias("kind")))
    return out.distinct()


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphan molecules by table, month and kind."""
    return orphans.groupBy("table_name", "period", "kind").agg(F.count(F.lit(1)).alias("molecules"))
