"""Percentiles of very large numeric columns from merging centroid digests.

A digest holds sorted values as clusters (mean, weight, low, high) whose sizes follow the quantile: small at both ends,
largest in the middle. Partial digests of partitions or days are merged by clustering their clusters again, so they can
be kept and combined later. Equal values stay together in one cluster of low = high, which loses nothing on columns with
few distinct values. A second pass counts the rows below and at each estimate and so certifies its rank error.

Usable values are neither null nor NaN nor infinite. A group without any has no digest and no row in the results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.session import join_checked, materialise

#: Twice the number of clusters, nearly; rank errors in the middle come to about 1.6/DELTA.
DELTA = 400.0
#: Stated bound of the rank error, as a share of the group's rows.
RANK_BOUND = 0.01
PERCENTILES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
#: Values held per worker before all are clustered.
_HELD = 1 << 20
_FAN_IN = 128

KEYS = ("grouping", "group_key", "metric")
_CLUSTERS = "means array<double>, weights array<bigint>, lows array<double>, highs array<double>"


def cluster(means: np.ndarray, weights: np.ndarray, lows: np.ndarray, highs: np.ndarray, delta: float = DELTA) -> tuple[np.ndarray, ...]:
    """Sorts and clusters again. Any mixture of raw values (weight 1, low = high) and clusters will do."""
    order = np.lexsort((highs, lows, means))
    means, weights, lows, highs = means[order], weights[order], lows[order], highs[order]
    point = lows == highs
    same = np.r_[False, (means[1:] == means[:-1]) & point[1:] & point[:-1]]
    means, weights, lows, highs, point = _fold(np.flatnonzero(~same), means, weights, lows, highs)
    total = weights.sum()
    middle = (np.cumsum(weights) - weights / 2) / total
    cell = np.floor(delta / (2 * np.pi) * np.arcsin(2 * middle - 1))
    # A point that would fill half a cell by itself stays alone.
    heavy = point & (weights >= np.pi / delta * np.sqrt(middle * (1 - middle)) * total)
    cut = np.r_[True, (cell[1:] != cell[:-1]) | heavy[1:] | heavy[:-1]]
    return _fold(np.flatnonzero(cut), means, weights, lows, highs)[:4]


def _fold(starts: np.ndarray, means: np.ndarray, weights: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, ...]:
    w = np.add.reduceat(weights, starts)
    lo, hi = np.minimum.reduceat(lows, starts), np.maximum.reduceat(highs, starts)
    # Weighted about the low end, so that equal values keep their exact mean.
    m = lo + np.add.reduceat((means - np.repeat(lo, np.diff(np.r_[starts, len(means)]))) * weights, starts) / w
    return np.minimum(np.maximum(m, lo), hi), w, lo, hi, lo == hi


def quantiles(means: np.ndarray, weights: np.ndarray, lows: np.ndarray, highs: np.ndarray, at: tuple[float, ...]) -> np.ndarray:
    """Values at the given shares of the rows; never decreasing with the share."""
    after = np.cumsum(weights)
    before = after - weights
    point = lows == highs
    x = np.stack([before, before + weights / 2, after], 1)
    y = np.stack([means, means, means], 1)
    keep = np.stack([point, ~point, point], 1)
    x, y = x[keep], y[keep]
    return np.interp(np.asarray(at) * after[-1], np.r_[0, x, after[-1]], np.r_[lows.min(), y, highs.max()])


class _Builder:
    def __init__(self, delta: float) -> None:
        self.delta, self.parts, self.held = delta, {}, 0

    def add(self, key: tuple, values: np.ndarray) -> None:
        if len(values):
            self.parts.setdefault(key, []).append((values, np.ones(len(values), np.int64), values, values))
            self.held += len(values)
            if self.held > _HELD:
                self.squeeze()

    def squeeze(self) -> None:
        for key, parts in self.parts.items():
            if len(parts) > 1 or len(parts[0][0]) > self.delta:
                self.parts[key] = [cluster(*(np.concatenate(p) for p in zip(*parts, strict=True)), delta=self.delta)]
        self.held = sum(len(p[0][0]) for p in self.parts.values())
        # Very many groups in one partition: what is left then is small in each, and a fresh limit keeps this linear.
        self.held = min(self.held, _HELD // 2)

    def rows(self) -> Iterator[tuple[tuple, tuple[np.ndarray, ...]]]:
        self.squeeze()
        for key, parts in self.parts.items():
            yield key, parts[0]


def partial_digests(df: DataFrame, groupings: dict[str, Column], metrics: list[str], delta: float = DELTA) -> DataFrame:
    """One digest for each partition, grouping, key and metric: grouping, group_key, metric, part, clusters. No shuffle.

    Group keys become text; a null key is a group of its own. Infinite and missing values are left out.
    """
    names = list(groupings)
    source = df.select(*[k.cast("string").alias(f"g{i}") for i, k in enumerate(groupings.values())], *[F.col(m).cast("double").alias(f"m{i}") for i, m in enumerate(metrics)], F.spark_partition_id().alias("part"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, part = _Builder(delta), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            values = [batch.column(f"m{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(metrics))]
            for g, name in enumerate(names):
                coded = batch.column(f"g{g}").dictionary_encode()
                codes = np.nan_to_num(coded.indices.to_numpy(zero_copy_only=False).astype(float), nan=-1).astype(int)
                order = np.argsort(codes, kind="stable")
                edges = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0, True])
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    rows = order[a:b]
                    code = codes[rows[0]]
                    key = None if code < 0 else coded.dictionary[int(code)].as_py()
                    for metric, v in zip(metrics, values, strict=True):
                        v = v[rows]
                        made.add((name, key, metric), v[np.isfinite(v)])
        out = list(made.rows())
        for i in range(0, len(out), 2000):
            some = out[i : i + 2000]
            keys = [pa.array([k[j] for k, _ in some], pa.string()) for j in range(3)]
            arrays = [pa.array([c[j].tolist() for _, c in some], pa.list_(t)) for j, t in enumerate((pa.float64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([part] * len(some), pa.int32()), *arrays], names=[*KEYS, "part", "means", "weights", "lows", "highs"])

    return source.mapInArrow(build, f"grouping string, group_key string, metric string, part int, {_CLUSTERS}")


def merge_digests(digests: DataFrame, by: list[str], delta: float = DELTA) -> DataFrame:
    """One digest for each value of the columns `by`, from any digests: partitions, days, files."""
    width = len(by)

    def merge(table: pa.Table) -> pa.Table:
        flat = [np.concatenate([np.asarray(v) for v in table.column(c).to_pylist()]) for c in ("means", "weights", "lows", "highs")]
        made = cluster(*flat, delta=delta)
        keys = [table.column(c).slice(0, 1).combine_chunks() for c in by]
        types = (pa.float64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table([*keys, *[pa.array([c.tolist()], pa.list_(t)) for c, t in zip(made, types, strict=True)]], names=[*by, "means", "weights", "lows", "highs"])

    source = digests.select(*by, "means", "weights", "lows", "highs")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:width])
    return source.groupBy(*by).applyInArrow(merge, f"{types}, {_CLUSTERS}")


def digests(df: DataFrame, groupings: dict[str, Column], metrics: list[str], delta: float = DELTA) -> DataFrame:
    """One digest for each grouping, key and metric.

    Partial digests are merged by _FAN_IN at a time until one is left: as many levels as the partitions of df need, so
    that no task ever gets more than _FAN_IN digests of a key, however many partitions have it.
    """
    made, left = partial_digests(df, groupings, metrics, delta), df.rdd.getNumPartitions()
    while left > _FAN_IN:
        made = merge_digests(made.withColumn("part", F.floor(F.col("part") / _FAN_IN).cast("int")), [*KEYS, "part"], delta)
        left = -(-left // _FAN_IN)
    return merge_digests(made, list(KEYS), delta)


def estimates(made: DataFrame, at: tuple[float, ...] = PERCENTILES) -> DataFrame:
    """grouping, group_key, metric, n and `estimates`, the values at the shares `at`, in their order."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["means", "weights", "lows", "highs"]).to_pylist()
            values = [quantiles(*(np.asarray(r[c], float) for c in ("means", "weights", "lows", "highs")), at).tolist() for r in rows]
            n = [sum(r["weights"]) for r in rows]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in KEYS], pa.array(n, pa.int64()), pa.array(values, pa.list_(pa.float64()))], names=[*KEYS, "n", "estimates"])

    return made.mapInArrow(ask, "grouping string, group_key string, metric string, n bigint, estimates array<double>")


def certify(df: DataFrame, groupings: dict[str, Column], metrics: list[str], found: DataFrame, at: tuple[float, ...] = PERCENTILES, bound: float = RANK_BOUND) -> DataFrame:
    """The second pass: counts rows below and at each estimate, and states the rank error.

    Each row is counted once by the number of estimates below and not above it, so the shuffle carries at most 4 counts
    for each estimate and task.
    """
    wide = found.withColumns({"_k": F.coalesce("group_key", F.lit("\0"))})
    each = F.array(*[F.struct(F.lit(g).alias("grouping"), F.coalesce(k.cast("string"), F.lit("\0")).alias("_k")) for g, k in groupings.items()])
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])
    long = df.select(each.alias("_g"), values.alias("_v")).select(F.explode("_g").alias("_g"), "_v").select("_g.*", F.explode("_v").alias("_v")).select("grouping", "_k", "_v.*")
    v = F.col("v")
    long = long.filter(v.isNotNull() & ~F.isnan(v) & ~v.isin(float("inf"), float("-inf")))
    met = join_checked(long, wide.select("grouping", "_k", "metric", "estimates"), ["grouping", "_k", "metric"], "inner")
    below = F.size(F.filter("estimates", lambda e: e < F.col("v")))
    upto = F.size(F.filter("estimates", lambda e: e <= F.col("v")))
    counts = met.groupBy("grouping", "_k", "metric", below.alias("lt"), upto.alias("le")).agg(F.count(F.lit(1)).alias("c"))
    # A value is below estimate i if at most i estimates are <= it, and at most it if at most i are < it.
    sums = [F.sum(F.when(F.col(side) <= i, F.col("c")).otherwise(0)).alias(f"{side}{i}") for i in range(len(at)) for side in ("le", "lt")]
    counted = counts.groupBy("grouping", "_k", "metric").agg(*sums)
    rows = F.explode(F.array(*[F.struct(F.lit(q).alias("share"), F.get("estimates", F.lit(i)).alias("estimate"), F.col(f"le{i}").alias("rows_below"), F.col(f"lt{i}").alias("rows_upto")) for i, q in enumerate(at)]))
    out = wide.join(counted, ["grouping", "_k", "metric"]).select(*KEYS, "n", rows.alias("x")).select(*KEYS, "n", "x.*")
    lo, hi, q = F.col("rows_below") / F.col("n"), F.col("rows_upto") / F.col("n"), F.col("share")
    return out.withColumn("rank_error", F.greatest(lo - q, q - hi, F.lit(0.0))).withColumn("certified", F.col("rank_error") <= bound)


def certified(df: DataFrame, groupings: dict[str, Column], metrics: list[str], make: Callable[[float], DataFrame], at: tuple[float, ...] = PERCENTILES, bound: float = RANK_BOUND, delta: float = DELTA, tries: int = 3) -> DataFrame:
    """Percentiles from the digests that `make(delta)` gives, whichever way they were merged, certified by a second pass over df.

    Where the second pass finds an estimate beyond the bound, all is done again with twice the clusters; after `tries`
    such rounds the remaining rows keep certified = false, and their true rank error.
    """
    for n in range(tries):
        made = materialise(estimates(make(delta * 2**n), at))
        out = materialise(certify(df, groupings, metrics, made, at, bound))
        if not out.filter("not certified").head(1):
            break
    return out


def percentiles(df: DataFrame, groupings: dict[str, Column], metrics: list[str], at: tuple[float, ...] = PERCENTILES, bound: float = RANK_BOUND, delta: float = DELTA, tries: int = 3) -> DataFrame:
    """Certified percentiles for each grouping, key and metric, `bound` holding for every row of the result."""
    return certified(df, groupings, metrics, lambda d: digests(df, groupings, metrics, d), at, bound, delta, tries)
