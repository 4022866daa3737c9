"""Chemical-state filter: the first failing check of a preset is the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import geometry_facts, record_facts, smiles_state
from corundum.schema import PRESETS


def signed(n: Column) -> Column:
    return F.concat(F.when(n < 0, "-").otherwise("+"), F.abs(n).cast("string"))


def state_reason(net: Column, charged: Column, unpaired: Column, preset: str = "neutral_closed_shell") -> Column:
    """charge=+1, zwitterion or radicals=2: the first check of the preset that fails, else null."""
    tests = {"charge": (net != 0, F.concat(F.lit("charge="), signed(net))), "zwitterion": (charged > 0, F.lit("zwitterion")), "radicals": (unpaired > 0, F.concat(F.lit("radicals="), unpaired.cast("string")))}
    return F.coalesce(*[F.when(*tests[name]) for name in PRESETS[preset]], F.lit(None).cast("string"))


def filter_smiles(df: DataFrame, smiles: str, preset: str = "neutral_closed_shell") -> DataFrame:
    """df with filter_status (ok, rejected) and filter_reason; a null or unreadable SMILES is `smiles_unparseable`."""
    facts = df.withColumn("__f", smiles_state(F.col(smiles)))
    reason = F.when(F.col("__f").isNull(), "smiles_unparseable").otherwise(state_reason(F.col("__f.net_charge"), F.col("__f.charged_atoms"), F.col("__f.radicals"), preset))
    return _tagged(facts, reason)


def block_record(df: DataFrame, geometry: bool = False) -> Column:
    """The facts of each row's mol_block; SMILES, if there is such a column, serves as the template for its bonds."""
    smiles = F.col("SMILES") if "SMILES" in df.columns else F.lit(None).cast("string")
    return geometry_facts(F.col("mol_block"), smiles, F.col("FormalCharge")) if geometry else record_facts(F.col("mol_block"), smiles)


def filter_blocks(
    df: DataFrame, preset: str = "neutral_closed_shell", elements: tuple[str, ...] | None = None, heavy: tuple[int, int] | None = None, geometry: bool = False, facts: Column | None = None
) -> DataFrame:
    """df with filter_status (ok, rejected, mol_corrupt) and filter_reason, from the blocks' own bonds and charges.

    `elements` and `heavy` are the documented options: a whitelist of elements and a range of heavy atoms; they are
    checked after the preset. With `geometry` bonds and charges are worked out from the coordinates and FormalCharge,
    and the block's own ones serve where that fails. `facts`: the result of block_record, if it is at hand.
    """
    out = df.withColumn("__f", block_record(df, geometry) if facts is None else facts)
    reason = state_reason(F.col("__f.net_charge"), F.col("__f.charged_atoms"), F.col("__f.radicals"), preset)
    if elements is not None:
        reason = F.coalesce(reason, F.when(~F.forall("__f.elements", lambda s: s.isin(*elements)), "element"))
    if heavy is not None:
        n = F.col("__f.heavy_atoms")
        reason = F.coalesce(reason, F.when(~n.between(*heavy), F.concat(F.lit("heavy_atoms="), n.cast("string"))))
    return _tagged(out, F.when(F.col("__f").isNull(), "could not parse mol_block").otherwise(reason), F.col("__f").isNull())


def _tagged(facts: DataFrame, reason: Column, corrupt: Column | None = None) -> DataFrame:
    out = facts.withColumn("filter_reason", reason)
    status = F.when(F.col("filter_reason").isNull(), "ok").otherwise("rejected")
    if corrupt is not None:
        status = F.when(corrupt, "mol_corrupt").otherwise(status)
    return out.withColumn("filter_status", status).drop("__f")


def reason_counts(df: DataFrame, reason: str = "filter_reason") -> DataFrame:
    """Rejected rows by reason, most frequent first."""
    return df.filter(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), reason)


def exclude(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose column is not the value; null is no value and stays."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))
