"""Statistics and reports as small DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import fingerprint, smiles_descriptors
from corundum.operators.medians import exact_median
from corundum.operators.similarity import nearest_neighbours
from corundum.session import materialise, salted_join, share_out

# Ranges of atom counts in the report, the main ones and the peaks.
ATOM_RANGES = ((12, 40), (41, 65), (66, 92))
ATOM_PEAKS = ((25, 35), (45, 55), (65, 75))


def usable(c: Column) -> Column:
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def status_counts(df: DataFrame, status: str) -> DataFrame:
    """Rows of each status, nulls too."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("rows"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """name, n, mean, median, min, max of the usable values; a column without any has nulls. Medians are exact."""
    one = df.agg(*[f(usable(F.col(c))).alias(f"{c}|{n}") for c in columns for n, f in (("n", F.count), ("mean", F.avg), ("min", F.min), ("max", F.max))]).first()
    rows = [(c, one[f"{c}|n"], one[f"{c}|mean"], exact_median(df, usable(F.col(c))), one[f"{c}|min"], one[f"{c}|max"]) for c in columns]
    return df.sparkSession.createDataFrame(rows, "name string, n bigint, mean double, median double, min double, max double")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """bin, low, high, rows: equal-width bins over the usable values, the last one closed. No values: no rows.

    Equal values all around get bins of width one about them, as numeric libraries do. Empty bins are listed.
    """
    v = usable(F.col(column))
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, low double, high double, rows bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    b = F.least(F.floor((v - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = df.filter(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    edge = lambda i: F.lit(lo) + i * ((hi - lo) / bins)
    every = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts), "bin", "left").select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), F.coalesce("rows", F.lit(0)).alias("rows"))


def range_buckets(df: DataFrame, column: str, ranges: Sequence[tuple[int, int]] = ATOM_RANGES + ATOM_PEAKS) -> DataFrame:
    """low, high, rows, share of the non-null values; both ends count, ranges may overlap. All null: shares are null."""
    c = F.col(column)
    sums = df.agg(F.count(c).alias("n"), *[F.count_if(c.between(lo, hi)).alias(f"b{i}") for i, (lo, hi) in enumerate(ranges)])
    each = F.array(*[F.struct(F.lit(lo).alias("low"), F.lit(hi).alias("high"), F.col(f"b{i}").alias("rows")) for i, (lo, hi) in enumerate(ranges)])
    return sums.select("n", F.explode(each).alias("x")).select("x.*", F.try_divide("x.rows", "n").alias("share"))


def threshold_share(df: DataFrame, tests: dict[str, tuple[str, Column]]) -> DataFrame:
    """name, rows, n, share: of each test (column, condition), over that column's usable values."""
    sums = df.agg(*[a for i, (c, cond) in enumerate(tests.values()) for a in (F.count_if(usable(F.col(c)).isNotNull() & cond).alias(f"rows{i}"), F.count(usable(F.col(c))).alias(f"n{i}"))])
    each = F.array(*[F.struct(F.lit(k).alias("name"), F.col(f"rows{i}").alias("rows"), F.col(f"n{i}").alias("n")) for i, k in enumerate(tests)])
    return sums.select(F.explode(each).alias("x")).select("x.*").withColumn("share", F.try_divide("rows", "n"))


#: Columns of the statistics table, in its order.
STATS_COLUMNS = ("CompoundID", "SourceID", "CanonicalSMILES", "MolWt", "TPSA", "logP", "nrot", "num_atoms", "Energy_Ha", "max_tanimoto")
# Polar surface below which a molecule counts as permeable, and similarity above which two are near duplicates.
TPSA_LIMIT, NEAR_DUPLICATE = 140.0, 0.85


def stats_table(batch: DataFrame, tanimoto: bool = False, divisor: int = 1, order: str = "row_seq") -> DataFrame:
    """One row for each record with a readable or unreadable SMILES: `order` and STATS_COLUMNS; num_atoms is the SMILES' own.

    Each distinct text is worked out once. With `tanimoto`, max_tanimoto is the largest similarity of the record's
    structure to that of any other record, 1 where a text repeats; it is asked for rows whose `order` is divisible by
    `divisor` and null for others. Unreadable texts have null numbers. Records without SMILES are left out.
    """
    rows = batch.filter("CanonicalSMILES <> ''").select(order, "CompoundID", "SourceID", "CanonicalSMILES", "Energy_Ha")
    asks = F.col(order) % divisor == 0
    forms = rows.groupBy("CanonicalSMILES").agg(F.count(F.lit(1)).alias("__rows"), F.min(order).alias("__form"), F.bool_or(asks).alias("__asks"))
    forms = materialise(share_out(forms).withColumns({"__f": smiles_descriptors(F.col("CanonicalSMILES")), "__bits": fingerprint(F.col("CanonicalSMILES")) if tanimoto else F.lit(None).cast("array<bigint>")}))
    known = forms.select("CanonicalSMILES", "__rows", *[F.col(f"__f.{c}").alias(c) for c in ("MolWt", "TPSA", "logP", "nrot", "num_atoms")], "__form", F.col("__bits").isNotNull().alias("__has"))
    if tanimoto:
        best = nearest_neighbours(forms, "__form", "__bits", asks="__asks").select(F.col("query_id").alias("__form"), F.col("max_tanimoto").alias("__best"))
        known = known.join(best, "__form", "left").withColumn("__best", F.when(F.col("__has") & (F.col("__rows") > 1), 1.0).otherwise(F.col("__best")))
    else:
        known = known.withColumn("__best", F.lit(None).cast("double"))
    met = salted_join(rows, known.drop("__form", "__has"), ["CanonicalSMILES"], "inner", weight="__rows", by=[order])
    return met.withColumn("max_tanimoto", F.when(asks, F.col("__best"))).select(order, *STATS_COLUMNS)


def descriptor_report(table: DataFrame, columns: Sequence[str] = ("num_atoms", "MolWt", "TPSA", "logP", "nrot", "Energy_Ha")) -> DataFrame:
    """describe() of a statistics table, with the share of polar surfaces below the limit."""
    have = [c for c in columns if c in table.columns]
    done = describe(table, have)
    if "TPSA" not in have:
        return done.withColumn("share_below_limit", F.lit(None).cast("double"))
    share = threshold_share(table, {"TPSA": ("TPSA", F.col("TPSA") < TPSA_LIMIT)}).select("name", F.col("share").alias("share_below_limit"))
    return done.join(F.broadcast(share), "name", "left")


def tanimoto_report(table: DataFrame, key: str = "CompoundID", order: str = "row_seq", value: str = "max_tanimoto") -> DataFrame:
    """n, mean, median, max, twins (similarity 1) and near duplicates with their shares, over the first row of each key.

    Null keys count as one key. Fewer than two values: no rows.
    """
    firsts = table.groupBy(key).agg(F.min_by(value, order).alias("v")).filter("v is not null")
    one = firsts.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.max("v").alias("max"), F.count_if(F.col("v") == 1).alias("twins"), F.count_if(F.col("v") > NEAR_DUPLICATE).alias("near_duplicates")).first()
    rows = [] if one["n"] < 2 else [(one["n"], one["mean"], exact_median(firsts, F.col("v")), one["max"], one["twins"], one["twins"] / one["n"], one["near_duplicates"], one["near_duplicates"] / one["n"])]
    return table.sparkSession.createDataFrame(rows, "n bigint, mean double, median double, max double, twins bigint, twins_share double, near_duplicates bigint, near_duplicates_share double")


def funnel(df: DataFrame, stages: Sequence[tuple[str, Column]], key: str, total: int | None = None) -> DataFrame:
    """stage_no, stage, rejected, passed: the running pass count in stage order, then the conformer step and the unique count.

    stages: (name, rejected by it). The conformer step takes what is left down to the distinct keys; if fewer are left
    than there are keys, counts come from different runs, and it rejects nothing.
    """
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("unique"), *[F.count_if(c).alias(f"s{i}") for i, (_, c) in enumerate(stages)]).first()
    left = counts["n"] if total is None else total
    rows = [(0, "input", 0, left)]
    for i, (name, _) in enumerate(stages):
        left -= counts[f"s{i}"]
        rows.append((i + 1, name, counts[f"s{i}"], left))
    gone = max(0, left - counts["unique"])
    rows.append((len(rows), "conformers", gone, left - gone))
    rows.append((len(rows), "unique", 0, counts["unique"]))
    return df.sparkSession.createDataFrame(rows, "stage_no int, stage string, rejected bigint, passed bigint")
