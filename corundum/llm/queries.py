"""Queries of the operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.ids import bare, compound_of, label, readable_compound, smiles_compound
from corundum.llm import digests as D
from corundum.llm import mixing, splits, survivors, tokens, toxicity
from corundum.session import fits, materialise, read_table

SUPPLIED = ("Energy_Ha", "HOMO_Ha", "LUMO_Ha", "PartialCharges")


# 1. Splits that keep related records together


def _compound_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = read_table(spark, sf_dir, "batch").select("row_seq", "CompoundID", "CanonicalSMILES")
    # One name: both are the 32 hex digits of the compound, and a record may have either alone.
    entities = {"compound": (readable_compound(F.col("CompoundID")), smiles_compound(F.col("CanonicalSMILES")))}
    keyed = batch.withColumn("compound_id", compound_of(F.col("CompoundID"), F.col("CanonicalSMILES")))
    return splits.with_components(keyed, entities, "row_seq").select("row_seq", "compound_id", "component_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.grouped_records(_compound_components(spark, sf_dir), "component_id", "compound_id").select("row_seq", "compound_id")


def _split_targets(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    targets = read_table(spark, sf_dir, "split_targets")
    if not fits(targets):
        raise ValueError("too many splits to plan")
    return {r["split_name"]: r["share"] for r in targets.collect()}


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of every batch record."""
    # Written once: the plan counts the rows before they are assigned.
    return splits.assign_splits(materialise(_compound_components(spark, sf_dir)), _split_targets(spark, sf_dir))


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, components and share of rows of each split beside its target."""
    done = p1_splits(spark, sf_dir).groupBy("split_name").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("component_id").alias("components"))
    total = done.agg(F.sum("rows").alias("_total"))
    return read_table(spark, sf_dir, "split_targets").join(done, "split_name", "left").crossJoin(F.broadcast(total)).select("split_name", "share", "rows", "components", (F.col("rows") / F.col("_total")).alias("reached"))


# 3. Percentiles


def _energy_groups() -> dict:
    return {"family": F.col("family"), "batch_file": F.col("batch_file"), "day": F.to_date("loaded_at")}


def p3_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified percentiles of energies and atom counts by family, batch file and day."""
    batch = read_table(spark, sf_dir, "batch").select("family", "batch_file", "loaded_at", "Energy_Ha", "num_atoms")
    return D.percentiles(batch, _energy_groups(), ["Energy_Ha", "num_atoms"])


def p3_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests themselves, for keeping and merging later."""
    batch = read_table(spark, sf_dir, "batch").select("family", "batch_file", "loaded_at", "Energy_Ha", "num_atoms")
    return D.digests(batch, _energy_groups(), ["Energy_Ha", "num_atoms"])


def p3_merged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified percentiles by month, estimated from nothing but the digests of its days; rows without loaded_at have no month."""
    batch = read_table(spark, sf_dir, "batch").select("loaded_at", "Energy_Ha", "num_atoms").filter("loaded_at is not null")

    def months(delta: float) -> DataFrame:
        days = D.digests(batch, {"day": F.to_date("loaded_at")}, ["Energy_Ha", "num_atoms"], delta)
        return D.merge_digests(days.withColumns({"grouping": F.lit("month"), "group_key": F.substring("group_key", 1, 7)}), list(D.KEYS), delta)

    return D.certified(batch, {"month": F.date_format("loaded_at", "yyyy-MM")}, ["Energy_Ha", "num_atoms"], months)


def p3_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable rows of each group, and whether all its percentiles are certified."""
    return p3_percentiles(spark, sf_dir).groupBy(*D.KEYS).agg(F.max("n").alias("n"), F.bool_and("certified").alias("certified"))


# 5. Best representative of each duplicate group


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = read_table(spark, sf_dir, "batch").select("row_seq", "CompoundID", "CanonicalSMILES", "dedup_status", "loaded_at", *SUPPLIED)
    keyed = batch.withColumn("compound_id", compound_of(F.col("CompoundID"), F.col("CanonicalSMILES")))
    status = bare(F.col("dedup_status"))
    # Unknown statuses rank with null ones.
    trust = F.when(status == "ok", 0).when(status == "conformerduplicate", 1).when(status == "bondassignmentfailed", 2).when(status == "molcorrupt", 3).otherwise(4)
    usable = {f: survivors.finite(F.col(f)) for f in SUPPLIED[:3]} | {"PartialCharges": survivors.not_blank(F.col("PartialCharges"))}
    return survivors.skyline_layers(survivors.representatives(keyed, "compound_id", usable, trust, "loaded_at", "row_seq")).filter("n >= 2")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = survivors.suppliers(_layers(spark, sf_dir), list(SUPPLIED))
    return found.select(F.col("group_id").alias("compound_id"), "field_name", F.col("tie").alias("row_seq"))


def p5_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One built record for each compound with several batch records."""
    built = survivors.survivors(_layers(spark, sf_dir), list(SUPPLIED))
    return built.withColumnsRenamed({"group_id": "compound_id", "n": "records", "base": "base_row_seq"})


# 6. Encoding


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", tokens.token_ids(F.col("text"), tokens.tokenizer_content()).alias("ids"))


# 7. Mixing


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", label(F.col("source")).alias("source"), "text")
    # Written once: sizes are needed for the rates and again for the copies, and encoding is the dear part.
    return materialise(docs.select("doc_id", "source", tokens.token_count(F.col("text"), tokens.tokenizer_content()).alias("n_tokens")))


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sizes = _sizes(spark, sf_dir)
    rated = mixing.rates(sizes, read_table(spark, sf_dir, "mix_targets"))
    return mixing.mixture(sizes, rated), rated


def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each copy of a document in the mixture."""
    return _mixed(spark, sf_dir)[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    mixed, rated = _mixed(spark, sf_dir)
    return mixing.reached(mixed, rated)


# 8. Abusive, hateful or sexual content


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, and whether it is flagged for review."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", label(F.col("source")).alias("source"), "text")
    return toxicity.with_scores(docs, read_table(spark, sf_dir, "review_labels")).drop("text")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_scores(spark, sf_dir).filter("flagged").select("doc_id")


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of flagged documents by source; null where a document names none."""
    flagged = F.count_if("flagged")
    return p8_scores(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), flagged.alias("flagged"), (flagged / F.count(F.lit(1))).alias("rate"))


QUERIES = {f.__name__: f for f in (p1_found, p1_splits, p1_shares, p3_percentiles, p3_digests, p3_merged_months, p3_bounds, p5_found, p5_survivors, p6_ids, p7_mixture, p7_shares, p8_scores, p8_found, p8_rates)}
