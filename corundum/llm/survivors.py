"""Best representative of each duplicate group, field by field.

Records of a group are compared on three axes: completeness (the set of fields with a usable value), trust and
recency. One record dominates another if it has at least its fields, its trust and its recency, and is ahead of it in
the lexicographic policy (trust, then recency, then smallest tie-breaker). The undominated records are the skyline,
layer 1; without them the next layer shows, and so on. A survivor takes each field from the first record, by layer and
then by policy, that has it usable.

Within records of equal completeness and trust the most recent one (smallest tie-breaker) dominates all others, so a
group is first reduced to at most 2**fields x trust levels records by a partial aggregate. A group that holds a third of
all rows is thus never collected; only these few representatives are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS_MAX = 8


def finite(value: Column) -> Column:
    """Whether a double is a usable number."""
    return F.coalesce(~F.isnan(value) & ~value.isin(float("inf"), float("-inf")), F.lit(False))


def not_blank(text: Column) -> Column:
    return F.coalesce(text.rlike(r"[^\s\p{Z}]"), F.lit(False))


def representatives(df: DataFrame, group: str, usable: dict[str, Column], trust: Column, recency: str, tie: str) -> DataFrame:
    """At most one row for each group, set of usable fields and trust: group, mask, trust, order, values.

    `trust` is a small integer, 0 the most trusted. Null groups are no groups. A null recency counts as the oldest.
    """
    if len(usable) > FIELDS_MAX:
        raise ValueError(f"at most {FIELDS_MAX} fields at once, as representatives grow with their subsets")
    mask = sum((F.when(ok, 1 << i).otherwise(0) for i, ok in enumerate(usable.values())), F.lit(0))
    age = -F.coalesce(F.unix_micros(F.col(recency).cast("timestamp")), F.lit(-(1 << 62)))
    rows = df.filter(F.col(group).isNotNull()).select(
        F.col(group).alias("group_id"), mask.alias("mask"), trust.alias("trust"), age.alias("age"), F.col(tie).alias("tie"), F.struct(*[F.col(f) for f in usable]).alias("values")
    )
    best = F.min_by("values", F.struct("age", "tie")).alias("values")
    return rows.groupBy("group_id", "mask", "trust").agg(F.min(F.struct("age", "tie")).alias("_order"), best, F.count(F.lit(1)).alias("n")).select(
        "group_id", "mask", "trust", F.col("_order.age").alias("age"), F.col("_order.tie").alias("tie"), "values", "n"
    )


def skyline_layers(reps: DataFrame, completeness: str = "set") -> DataFrame:
    """One row for each group: `n` records and `ranked`, its representatives with their dominance layer, best first.

    The representatives are sorted by policy; whatever dominates a record stands before it, so its layer is one more
    than the deepest layer among its dominators, found in one pass.

    completeness: `set`, a dominator has all fields that the record has, or `count`, at least as many. By `set` the
    first record by policy that has a field is never dominated, since its dominator would have the field and come
    first: fields come from layer 1, in the order of the policy alone. By `count` a record may be dominated by one that
    lacks its field, which is then filled from a deeper layer.
    """
    if completeness not in ("set", "count"):
        raise ValueError(f"no completeness {completeness}")
    item = F.struct("trust", "age", "tie", "mask", "values")
    groups = reps.groupBy("group_id").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(item)).alias("items"))
    layered_type = groups.schema["items"].dataType.elementType.simpleString()

    def layer(done: Column, x: Column) -> Column:
        has = (lambda s: s["mask"].bitwiseAND(x["mask"]) == x["mask"]) if completeness == "set" else (lambda s: F.bit_count(s["mask"]) >= F.bit_count(x["mask"]))
        over = F.filter(done, lambda s: has(s) & (s["trust"] <= x["trust"]) & (s["age"] <= x["age"]))
        return F.coalesce(F.array_max(F.transform(over, lambda s: s["layer"])), F.lit(0)) + 1

    start = F.expr(f"CAST(array() AS array<struct<layer:int,{layered_type[len('struct<'):]}>)")
    ranked = F.aggregate(
        "items", start,
        lambda done, x: F.concat(done, F.array(F.struct(layer(done, x).alias("layer"), *[x[c].alias(c) for c in ("trust", "age", "tie", "mask", "values")]))),
    )
    return groups.select("group_id", "n", F.array_sort(ranked).alias("ranked"))


def suppliers(layers: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each group and field with a usable value: group_id, n, field_name, tie (of the supplier), layer."""
    one = lambda i: F.get(F.filter("ranked", lambda x: x["mask"].bitwiseAND(F.lit(1 << i)) != 0), F.lit(0))
    each = F.array(*[F.struct(F.lit(f).alias("field_name"), one(i).alias("best")) for i, f in enumerate(fields)])
    rows = layers.select("group_id", "n", F.explode(each).alias("x")).filter("x.best is not null")
    return rows.select("group_id", "n", F.col("x.field_name").alias("field_name"), F.col("x.best.tie").alias("tie"), F.col("x.best.layer").alias("layer"))


def survivors(layers: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each group: group_id, n, base (the leading record), the fields, and how many came from other records."""
    one = lambda i: F.get(F.filter("ranked", lambda x: x["mask"].bitwiseAND(F.lit(1 << i)) != 0), F.lit(0))
    base = F.get("ranked", F.lit(0))
    filled = sum((F.when(one(i)["tie"] != base["tie"], 1).otherwise(0) for i in range(len(fields))), F.lit(0))
    return layers.select("group_id", "n", base["tie"].alias("base"), *[one(i)["values"][f].alias(f) for i, f in enumerate(fields)], filled.alias("filled_from_others"))
