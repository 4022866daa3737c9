"""Molecules from tables of atoms and bonds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import fixed_text
from corundum.functions.ids import zinc_name
from corundum.session import salted_join


def _deliveries(df: DataFrame, keep: str, columns: list[str]) -> DataFrame:
    """Rows of each molecule's deliveries with its normal id `key`; `first` delivery only, or `all`.

    A delivery is what shares id and loaded_at: it has the size of a molecule, however often a molecule comes again.
    Rows without loaded_at are the last delivery; in a table without that column all rows of a molecule are one.
    """
    if "loaded_at" not in df.columns:
        df = df.withColumn("loaded_at", F.lit(None).cast("timestamp"))
    out = df.select(zinc_name(F.col("Zinc_id")).alias("key"), F.coalesce(F.col("loaded_at").cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz")).alias("loaded_at"), *columns).filter("key is not null")
    if keep == "all":
        return out
    rows = out.groupBy("key", "loaded_at").agg(F.count(F.lit(1)).alias("__rows"))
    first = rows.groupBy("key").agg(F.min(F.struct("loaded_at", "__rows")).alias("__first")).select("key", "__first.*")
    return salted_join(out, first, ["key", "loaded_at"], "inner", weight="__rows", by=columns[:1])


def atom_lists(xyz: DataFrame, keep: str = "first") -> DataFrame:
    """key, loaded_at, symbols, coordinates (flattened), charges: one row for each delivery of a molecule, atoms in order of xyz_seq.

    Symbols are trimmed and written with one capital. Null ids are left out; NaN coordinates and null charges stay.
    """
    rows = _deliveries(xyz, keep, ["xyz_seq", "atom", "final_x", "final_y", "final_z", "charge"]).withColumn("atom", F.initcap(F.trim("atom")))
    atoms = F.array_sort(F.collect_list(F.struct("xyz_seq", "atom", "final_x", "final_y", "final_z", "charge"))).alias("a")
    one = rows.groupBy("key", "loaded_at").agg(atoms)
    return one.select(
        "key", "loaded_at", F.transform("a", lambda x: x["atom"]).alias("symbols"),
        F.flatten(F.transform("a", lambda x: F.array(x["final_x"], x["final_y"], x["final_z"]))).alias("coordinates"), F.transform("a", lambda x: x["charge"]).alias("charges"),
    )


def bond_lists(bond: DataFrame, keep: str = "first") -> DataFrame:
    """key, bonds: pairs of different atoms in order of bond_seq, each once; unusable ones are left out."""
    rows = _deliveries(bond, keep, ["bond_seq", "atom1", "atom2"]).filter("atom1 > 0 and atom2 > 0 and atom1 <> atom2")
    pairs = F.array_sort(F.collect_list(F.struct("bond_seq", "atom1", "atom2")))
    one = rows.groupBy("key", "loaded_at").agg(pairs.alias("b"))
    return one.select("key", F.transform("b", lambda x: F.struct(x["atom1"].alias("a"), x["atom2"].alias("b"))).alias("bonds"))


def formal_charge(charges: Column, exact: bool = True) -> Column:
    """The sum of partial charges to the nearest integer, ties to even; null if one is missing, not finite or beyond a billion.

    Charges are added as decimals of twelve places, so that no order of adding moves a sum off a tie; if not exact, as
    doubles in the order of the array, whose rounding may do so.
    """
    if not exact:
        total = F.aggregate(charges, F.lit(0.0), lambda s, q: s + q)
        return F.when(F.abs(total) < 1_000_000_000, F.rint(total).cast("int"))
    # Twelve places more than doubles of this size can carry, and sums of up to a million of them fit.
    zero = F.lit(0).cast("decimal(30,12)")
    total = F.aggregate(charges, zero, lambda s, q: (s + q.try_cast("decimal(22,12)")).cast("decimal(30,12)"))
    return F.when(F.abs(total) < 1_000_000_000, F.bround(total, 0).cast("int"))


def assemble(main: DataFrame, xyz: DataFrame, bond: DataFrame, honour_status: bool = True, exact: bool = True) -> DataFrame:
    """One record for each main row with atoms: main inner join atoms, left join bonds, in the batch's columns.

    A repeated main row gives a record each; a molecule without atoms is skipped, one without bonds has none. Rows that
    an earlier prefilter flagged are skipped if honour_status. Bonds beyond the atoms are left out; all are single.
    Charges are added exactly, or as doubles in the order of atoms if not exact.
    """
    lacking = [c for c in ("Internal_E(0K)", "HOMO", "LUMO", "HL_gap") if c not in main.columns]
    keyed = main.withColumns({c: F.lit(None).cast("double") for c in lacking} | {"key": zinc_name(F.col("Zinc_id"))})
    if honour_status and "energy_status" in main.columns:
        keyed = keyed.filter("energy_status = 'ok'")
    # Lists are joined to lists first, one row for each molecule on both sides; main, which may repeat one, comes then.
    built = atom_lists(xyz).drop("loaded_at").join(bond_lists(bond), "key", "left")
    met = salted_join(keyed.select("key", "smile", "`Internal_E(0K)`", "HOMO", "LUMO", "HL_gap"), built, ["key"], "inner")
    n = F.size("symbols")
    bonds = F.array_distinct(F.filter(F.coalesce("bonds", F.array().cast("array<struct<a:int,b:int>>")), lambda b: (b["a"] <= n) & (b["b"] <= n)))
    return met.withColumn("bonds", bonds).select(
        F.col("key").alias("SourceID"), F.col("smile").alias("SMILES"), F.col("`Internal_E(0K)`").alias("Energy_Ha"), formal_charge(F.col("charges"), exact).alias("FormalCharge"),
        F.lit(1).alias("Multiplicity"), F.col("HOMO").alias("HOMO_Ha"), F.col("LUMO").alias("LUMO_Ha"), F.col("HL_gap").alias("HL_Gap_Ha"),
        n.alias("num_atoms"), F.size("bonds").alias("num_bonds"), "symbols", "coordinates", "charges", "bonds",
    )


def charge_text(charges: Column) -> Column:
    """Partial charges with six decimals, joined by blanks."""
    from pyspark.sql.types import StringType

    from corundum.functions.arrow import by_row

    def text(values: list | None) -> str | None:
        return None if values is None else " ".join("nan" if q is None else f"{q:.6f}" for q in values)

    return by_row(text, StringType())(charges)


def energy_text(energy: Column) -> Column:
    return fixed_text(8)(energy)


def record_tags() -> dict[str, Column]:
    """The tags of an assembled molecule's record as fixed-precision text, in their order."""
    tags = {"Energy_Ha": energy_text(F.col("Energy_Ha")), "FormalCharge": F.col("FormalCharge"), "Multiplicity": F.col("Multiplicity"), "SMILES": F.col("SMILES"), "SourceID": F.col("SourceID")}
    return tags | {t: fixed_text(6)(F.col(t)) for t in ("HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha")} | {"PartialCharges": charge_text(F.col("charges"))}
