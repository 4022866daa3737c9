"""Cross-stage integrity of batch records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.v2000 import head_counts, head_line


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def integrity(batch: DataFrame, readable: Column, canonical: Column | None = None, counted: tuple[Column, Column] | None = None) -> DataFrame:
    """batch with validate_status (ok, invalid) and validate_errors (joined by "; ", null if none).

    `readable`: whether the block parses; if not, that is the only error. Then atom and bond counts against the counts
    line, the energy, the CompoundID against the MD5 of the CanonicalSMILES, and, if `canonical` gives a recomputed
    text, the CanonicalSMILES against it. Null or empty ids and texts are not compared. `counted`: atoms and bonds of
    the counts line, if they are at hand.
    """
    if counted is None:
        batch = batch.withColumn("__head", head_line(F.col("mol_block")))
    atoms, bonds = counted or head_counts(F.col("__head"))
    stored, cid, e = F.col("CanonicalSMILES"), F.col("CompoundID"), F.col("Energy_Ha")
    differs = lambda name, found: F.when(~F.col(name).eqNullSafe(found), F.concat(F.lit(f"{name} mismatch: stored="), _text(F.col(name)), F.lit(", mol="), _text(found)))
    tests = [differs("num_atoms", atoms), differs("num_bonds", bonds)]
    if canonical is not None:
        tests.append(F.when((stored != "") & (canonical != stored), F.concat(F.lit("CanonicalSMILES mismatch: stored="), stored, F.lit(", recomputed="), canonical)))
    tests.append(F.when(e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")), "Energy_Ha: not finite"))
    own = F.md5(stored.cast("binary"))
    tests.append(F.when((cid != "") & (stored != "") & (own != cid), F.concat(F.lit("CompoundID mismatch: stored="), cid, F.lit(", recomputed="), own)))
    errors = F.when(F.coalesce(readable, F.lit(False)), F.concat_ws("; ", *tests)).otherwise("mol_block: could not parse")
    out = batch.withColumn("validate_errors", F.nullif(errors, F.lit("")))
    return out.withColumn("validate_status", F.when(F.col("validate_errors").isNull(), "ok").otherwise("invalid")).drop("__head")
