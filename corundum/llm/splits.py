"""Splits that keep related records together.

Records that share an entity (an author, a source, a compound key ...) are joined by connected components, found with
alternating large-star and small-star steps over entity nodes. A component's identifier is then hashed into split
ranges.

The hash is a place on a ring of RING buckets, and the splits are arcs of it. One rule holds for components of any
size: the rows of each bucket are counted, and the arcs are cut where the running share of rows reaches the targets. A
component with a large part of all rows makes its bucket heavy; of a fixed number of turns and strides of the ring the
one is taken whose arcs come nearest to the targets, so that a heavy bucket falls inside an arc that holds it. The plan
(stride, turn, edges) is a few numbers and can be kept: under a kept plan no component ever moves, however rows grow.

Records never become nodes: a record with several entities gives the edges of a star over them, and edges are distinct
before the first step, so an entity that a third of all records share costs one node.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.session import join_checked, materialise, release, salted_join

#: Buckets of the ring, and the strides and turns that a plan chooses from.
RING = 1 << 16
STRIDES = tuple(range(1, 32, 2))
TURNS = 64
PLAN_VERSION = 1


def entity_nodes(df: DataFrame, entities: dict[str, Column | tuple[Column, ...]]) -> DataFrame:
    """df with `__nodes`: the record's entities as distinct text nodes `name:value`, nulls left out.

    Several columns of one name are spellings of one entity: equal values are one node, whichever column has them.
    """
    spelt = [(name, v) for name, value in entities.items() for v in (value if isinstance(value, tuple) else (value,))]
    nodes = F.array(*[F.concat(F.lit(f"{name}:"), v.cast("string")) for name, v in spelt])
    return df.withColumn("__nodes", F.array_distinct(F.filter(nodes, lambda x: x.isNotNull())))


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct edges (a, b) with a > b."""
    return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(arcs: DataFrame, large: bool) -> DataFrame:
    """One step over arcs (u, v): each u links neighbours to the least of them and itself, m.

    Large-star links the neighbours above u, small-star u itself and those below it. The least neighbour is a partial
    aggregate; a node with very many neighbours is salted when it is joined back.
    """
    least = arcs.groupBy("u").agg(F.min("v").alias("_v"), F.count(F.lit(1)).alias("_degree")).select("u", F.least("u", "_v").alias("m"), "_degree")
    near = salted_join(arcs, least, ["u"], "inner", weight="_degree")
    if large:
        return _pairs(near.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
    return _pairs(near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (a, b); the component is its least node.

    Alternates large-star and small-star until a round changes no edge; every round is a reliable checkpoint. Self
    loops and repeated edges count as nothing beyond their nodes. Raises if max_rounds rounds don't suffice.
    """
    edges = materialise(_pairs(edges))
    if not edges.head(1):
        # Nothing is linked: no node of an edge, no component.
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    before = None
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        big = _star(both, large=True)
        last, edges = edges, materialise(_star(big.select(F.col("a").alias("u"), F.col("b").alias("v")), large=False))
        release(last)
        # The edge set as a number: equal sets have equal counts and equal sums of hashes (a decimal, so it can't overflow).
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def with_components(df: DataFrame, entities: dict[str, Column | tuple[Column, ...]], row_id: str) -> DataFrame:
    """df with `component_id` (string): equal for records that share an entity, directly or through others.

    A record without any entity is a component of its own, `row:<row_id>`. Works on empty tables; repeated rows share
    their component; df may have columns of any other name.
    """
    nodes = entity_nodes(df, entities)
    first = F.get("__nodes", F.lit(0))
    star = nodes.select("__nodes").filter(F.size("__nodes") > 1).distinct()
    edges = star.select(first.alias("b"), F.explode(F.slice("__nodes", 2, 1 << 20)).alias("a"))
    components = connected_components(edges).select(F.col("node").alias("__first"), F.col("component").alias("__component"))
    named = join_checked(nodes.withColumn("__first", first), components, ["__first"])
    own = F.concat(F.lit("row:"), F.col(row_id).cast("string"))
    return named.withColumn("component_id", F.coalesce("__component", "__first", own)).drop("__nodes", "__first", "__component")


@dataclass(frozen=True)
class SplitPlan:
    """Arcs of the ring: names and their last places, in order; places are bucket x stride + turn, round the ring."""

    names: tuple[str, ...]
    edges: tuple[int, ...]
    stride: int
    turn: int
    seed: int
    version: int = PLAN_VERSION

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> SplitPlan:
        d = json.loads(text)
        if d["version"] != PLAN_VERSION:
            raise ValueError(f"a plan of version {d['version']}; this module writes and reads {PLAN_VERSION}")
        return SplitPlan(**d | {"names": tuple(d["names"]), "edges": tuple(d["edges"])})


def ring_bucket(component: Column, seed: int) -> Column:
    """The bucket of a component: the first 16 bits of an MD5 over seed and identifier."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), component).cast("binary")), 1, 4), 16, 10).cast("int")


def plan_splits(df: DataFrame, targets: dict[str, float], component: str = "component_id", seed: int = 17) -> SplitPlan:
    """The plan whose shares of rows are nearest to the targets; depends on nothing but identifiers and row counts.

    A bucket belongs to the split in whose target range the middle of its rows falls. Only counts by bucket, at most RING
    rows, come to the driver. Targets are scaled to sum to one; null and zero ones get nothing; at least one must be
    positive. Without rows the arcs are as long as the targets.
    """
    targets = {k: v for k, v in sorted(targets.items()) if v and v > 0}
    if not targets:
        raise ValueError("no split has a positive share")
    scale = sum(targets.values())
    shares = np.array([v / scale for v in targets.values()])
    upto = np.cumsum(shares)
    mass = np.zeros(RING, np.int64)
    for r in df.groupBy(ring_bucket(F.col(component), seed).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():
        mass[r["b"]] = r["n"]
    total = int(mass.sum())
    buckets = np.arange(RING)
    best = None
    for stride in STRIDES:
        for turn in range(TURNS) if total else (0,):
            place = (buckets * stride + turn * (RING // TURNS)) % RING
            on_ring = np.empty(RING, np.int64)
            on_ring[place] = mass
            middle = (np.cumsum(on_ring) - on_ring / 2) / total if total else (buckets + 0.5) / RING
            split = np.minimum(np.searchsorted(upto, middle, side="right"), len(upto) - 1)
            got = np.bincount(split, on_ring, len(upto)) / max(total, 1)
            off = np.abs(got - shares).max()
            if best is None or off < best[0]:
                best = (off, stride, turn * (RING // TURNS), tuple(int(e) - 1 for e in np.searchsorted(split, np.arange(len(upto)), side="right")))
    _, stride, turn, edges = best
    return SplitPlan(tuple(targets), (*edges[:-1], RING - 1), stride, turn, seed)


def assign_splits(df: DataFrame, targets: dict[str, float], component: str = "component_id", seed: int = 17, plan: SplitPlan | None = None) -> DataFrame:
    """df with `split_name`: one split for each component, shares of rows near the targets.

    `plan`: the plan of an earlier run, by which every component stays where it was; targets are then not read.
    """
    plan = plan or plan_splits(df, targets, component, seed)
    place = F.pmod(ring_bucket(F.col(component), plan.seed) * plan.stride + plan.turn, F.lit(RING))
    arcs = list(zip(plan.names, plan.edges, strict=True))
    return df.withColumn("split_name", reduce(lambda later, arc: F.when(place <= arc[1], arc[0]).otherwise(later), reversed(arcs[:-1]), F.lit(arcs[-1][0])))


def grouped_records(df: DataFrame, component: str, key: str, least: int = 2) -> DataFrame:
    """Rows of df whose key, within its component, has at least `least` rows; null keys have none."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(component, key).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") >= least)
    return salted_join(df, counts, [component, key], "inner", weight="__rows")
