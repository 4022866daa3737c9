"""Mirror-image removal over SMILES."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import smiles_stereo
from corundum.operators.dedup import mirror_removal
from corundum.session import materialise, salted_join, share_out


def stereo_filter(df: DataFrame, smiles: str = "CanonicalSMILES", order: str = "row_seq", facts: Column | None = None) -> DataFrame:
    """df with stereo_status: kept, removed_enantiomer, skipped_no_smiles (null or empty) or smiles_unparseable.

    `facts`: a struct with canonical, mirrored and has_stereo of the structure that `smiles` shows, if it is at hand.
    Otherwise each distinct text is worked out once, and classes of mirror images are settled among the texts, of which
    each stands for its first row.
    """
    none = F.coalesce(F.col(smiles), F.lit("")) == ""
    if facts is not None:
        found = df.withColumn("__f", F.when(~none, facts))
        has = F.col("__f.has_stereo")
        done = mirror_removal(found, F.when(has, F.col("__f.canonical")), F.when(has, F.col("__f.mirrored")), order)
        status = F.when(none, "skipped_no_smiles").when(F.col("__f").isNull(), "smiles_unparseable").otherwise(F.col("stereo_status"))
        return done.withColumn("stereo_status", status).drop("__f")
    seen = df.filter(F.col(smiles) != "").groupBy(smiles).agg(F.min(order).alias("__seen"), F.count(F.lit(1)).alias("__rows"))
    f = F.col("__f")
    forms = materialise(
        share_out(seen).withColumn("__f", smiles_stereo(F.col(smiles))).select(
            smiles, "__seen", "__rows", f.isNull().alias("__bad"), f["mirrored"].alias("__m"), f["canonical"].alias("__s"),
            F.when(f["has_stereo"], F.to_json(F.array(F.least(f["canonical"], f["mirrored"]), F.greatest(f["canonical"], f["mirrored"])))).alias("__class"),
        )
    )
    firsts = forms.filter("__class is not null").groupBy("__class").agg(F.min("__seen").alias("__first"), F.min_by("__s", "__seen").alias("__first_form"), F.count(F.lit(1)).alias("__forms"))
    settled = salted_join(forms, firsts, ["__class"], "left", weight="__forms", by=["__seen"])
    # Only a text whose mirror image is the first one's can lose rows, and it loses all but the first row itself.
    settled = materialise(settled.select(smiles, "__rows", "__bad", F.when(F.col("__m") == F.col("__first_form"), F.col("__first")).alias("__keeps")))
    met = salted_join(df, settled, [smiles], "left", weight="__rows", by=[order])
    status = F.when(none, "skipped_no_smiles").when(F.col("__bad"), "smiles_unparseable").when(F.col("__keeps") != F.col(order), "removed_enantiomer").otherwise("kept")
    return met.withColumn("stereo_status", status).select(*[c for c in df.columns if c != "stereo_status"], "stereo_status")
