"""Mixing sources to target weights.

Tokens are summed for each source; a source's repetition rate is what fills its target, at most its cap. A document is
emitted floor(rate) times and once more with the probability of the fraction, drawn from a seeded hash of its id, so that
the mixture is the same however the rows are laid out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.ids import label
from corundum.session import join_checked


def rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each target source: source, target_share, max_repeats, documents, source_tokens, total_tokens, rate.

    sizes: one row for each document with source (a label or null) and n_tokens. The goal of a source is target_share
    of all tokens of all documents. Target sources spelled alike are one, their shares added, the larger cap holding; a
    null share counts as 0 and a null or negative cap as 0. A source without tokens has rate 0.
    """
    have = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("source_tokens"))
    total = have.agg(F.coalesce(F.sum("source_tokens"), F.lit(0)).alias("total_tokens"))
    goals = targets.select(label(F.col("source")).alias("source"), "target_share", "max_repeats").filter("source is not null").groupBy("source").agg(
        F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.greatest(F.coalesce(F.max("max_repeats"), F.lit(0)), F.lit(0)).cast("int").alias("max_repeats")
    )
    out = goals.join(have, "source", "left").crossJoin(F.broadcast(total))
    want = F.try_divide(F.col("target_share") * F.col("total_tokens"), F.col("source_tokens"))
    return out.select(
        "source", "target_share", "max_repeats", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("source_tokens", F.lit(0)).alias("source_tokens"), "total_tokens",
        F.when(want.isNotNull(), F.least(want, F.col("max_repeats").cast("double"))).otherwise(0.0).alias("rate"),
    )


def copies(rate: Column, doc_id: Column, seed: int) -> Column:
    """Times a document is used: floor(rate), and one more with the probability of the fraction."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), doc_id), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def mixture(sizes: DataFrame, rated: DataFrame, seed: int = 29) -> DataFrame:
    """One row for each copy: the columns of sizes and copy_no from 1. Sources that are no target are left out."""
    met = join_checked(sizes, rated.select("source", "rate"), ["source"], "inner")
    used = met.withColumn("__copies", copies(F.col("rate"), F.col("doc_id"), seed)).filter("__copies > 0")
    return used.select(*sizes.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("copy_no"))


def reached(mixed: DataFrame, rated: DataFrame) -> DataFrame:
    """Shares by target source: reached_share of all tokens there were, mix_share of the tokens emitted, and `met` (within 2 percent of the target)."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("emitted_tokens"), F.count(F.lit(1)).alias("emitted_documents"))
    total = got.agg(F.sum("emitted_tokens").alias("__emitted"))
    out = rated.join(got, "source", "left").crossJoin(F.broadcast(total)).fillna(0, ["emitted_tokens", "emitted_documents"])
    share = F.coalesce(F.try_divide("emitted_tokens", "total_tokens"), F.lit(0.0))
    return out.select(
        "source", "target_share", "max_repeats", "documents", "source_tokens", "rate", "emitted_documents", "emitted_tokens", share.alias("reached_share"),
        F.coalesce(F.try_divide("emitted_tokens", "__emitted"), F.lit(0.0)).alias("mix_share"), (share >= F.col("target_share") * 0.98).alias("met"),
    )
