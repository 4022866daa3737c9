"""Identity and duplicates: first occurrences, mirror images, collisions.

A group's first row is a partial aggregate joined back with salt, not a window over the group, so that a compound
with a third of all rows is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import record_facts
from corundum.session import salted_join


def first_occurrence(df: DataFrame, key: str, order: str, eligible: Column | None = None) -> DataFrame:
    """df with dedup_status and ICONF: the first row of each key by `order` is `ok` with ICONF 1, others are `conformer_duplicate`.

    `order` must be unique. Rows with a null key, and rows that are not eligible, get neither and never come first.
    """
    may = F.col(key).isNotNull() if eligible is None else F.col(key).isNotNull() & F.coalesce(eligible, F.lit(False))
    marked = df.withColumn("__may", may)
    firsts = marked.groupBy(key).agg(F.min(F.when(F.col("__may"), F.col(order))).alias("__first"), F.count(F.lit(1)).alias("__rows")).filter(F.col(key).isNotNull())
    out = salted_join(marked, firsts, [key], "left", weight="__rows", by=[order])
    status = F.when(F.col("__may"), F.when(F.col(order) == F.col("__first"), "ok").otherwise("conformer_duplicate"))
    return out.withColumns({"dedup_status": status, "ICONF": F.when(F.col("__may") & (F.col(order) == F.col("__first")), F.lit(1))}).drop("__may", "__first").select(*[c for c in df.columns if c not in ("dedup_status", "ICONF")], "dedup_status", "ICONF")


def canonicalize(batch: DataFrame, facts: Column | None = None) -> DataFrame:
    """batch with CanonicalSMILES, CompoundID (its MD5), dedup_status and dedup_reason as far as the structure decides.

    `mol_corrupt` for unreadable blocks, `bond_assignment_failed` where aromatic bonds can't be written and SMILES is no
    template for them; others are open (null) until first_occurrence. `facts`: record_facts of the rows, if at hand.
    """
    if facts is None:
        smiles = F.col("SMILES") if "SMILES" in batch.columns else F.lit(None).cast("string")
        facts = record_facts(F.col("mol_block"), smiles)
    out = batch.withColumn("__t", facts)
    bad, untold = F.col("__t").isNull(), F.col("__t.canonical").isNull()
    return out.withColumns(
        {
            "CanonicalSMILES": F.col("__t.canonical"), "CompoundID": F.md5(F.col("__t.canonical").cast("binary")),
            "dedup_status": F.when(bad, "mol_corrupt").when(untold, "bond_assignment_failed"),
            "dedup_reason": F.when(bad, "could not parse mol_block").when(untold, F.col("__t.texts_missing")),
        }
    ).drop("__t")


def deduplicate(batch: DataFrame, eligible: Column | None = None, facts: Column | None = None) -> DataFrame:
    """canonicalize, then first occurrences over row_seq; rows without a text keep their status."""
    named = canonicalize(batch, facts).withColumnRenamed("dedup_status", "__status")
    done = first_occurrence(named, "CompoundID", "row_seq", eligible)
    return done.withColumn("dedup_status", F.coalesce("__status", "dedup_status")).drop("__status")


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the first by `order`; rows with a null key are left out."""
    return first_occurrence(df.filter(F.col(key).isNotNull()), key, order).filter("dedup_status = 'ok'").select(*df.columns)


def mirror_removal(df: DataFrame, form: Column, mirrored: Column, order: str) -> DataFrame:
    """df with stereo_status: in each class {form, mirrored form} the first row by `order` wins, and a later row goes if its mirrored form is the first one's.

    A null form or mirrored form means no stereo: kept. Exact repeats of the first stay; a form that is its own mirror
    image counts as mirroring its first row.
    """
    out = df.withColumns({"__s": form, "__m": mirrored})
    out = out.withColumn("__class", F.when(F.col("__s").isNotNull() & F.col("__m").isNotNull(), F.to_json(F.array(F.least("__s", "__m"), F.greatest("__s", "__m")))))
    firsts = out.filter("__class is not null").groupBy("__class").agg(F.min(order).alias("__first"), F.min_by("__s", order).alias("__first_form"), F.count(F.lit(1)).alias("__rows"))
    met = salted_join(out, firsts, ["__class"], "left", weight="__rows", by=[order])
    gone = (F.col(order) != F.col("__first")) & (F.col("__m") == F.col("__first_form"))
    return met.withColumn("stereo_status", F.when(gone, "removed_enantiomer").otherwise("kept")).select(*[c for c in df.columns if c != "stereo_status"], "stereo_status")


def collisions(df: DataFrame, key: str, form: str) -> DataFrame:
    """Keys with more than one form, and duplicates: key, rows, forms.

    A collision is one key over different forms; rows of one form are duplicates and no collision.
    """
    forms = df.filter(F.col(key).isNotNull()).groupBy(key, form).agg(F.count(F.lit(1)).alias("__n"))
    return forms.groupBy(key).agg(F.sum("__n").alias("rows"), F.count(form).alias("forms"))
