"""Fixed schemas and tag contracts of the pipeline."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

# The tags of an input record and the kind of value of each.
REQUIRED = {"Energy_Ha": "float", "FormalCharge": "int", "Multiplicity": "int"}
RECOMMENDED = {"SMILES": "str", "SourceID": "str"}
OPTIONAL = {"HOMO_Ha": "float", "LUMO_Ha": "float", "HL_Gap_Ha": "float", "PartialCharges": "str"}

# Order of the tags in a file of rejects.
REJECT_TAGS = ("SourceID", "SMILES", "Energy_Ha", "FormalCharge", "Multiplicity", "HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "PartialCharges", "num_atoms", "num_bonds", "energy_status")

_S, _D, _I = StringType(), DoubleType(), IntegerType()

#: One row, one molecule. NULL is missing and NaN is a value; every status may be null before its stage.
BATCH = StructType(
    [StructField("row_seq", LongType())]
    + [StructField(n, t) for n, t in (("CompoundID", _S), ("Energy_Ha", _D), ("FormalCharge", _I), ("Multiplicity", _I), ("SMILES", _S), ("SourceID", _S), ("HOMO_Ha", _D), ("LUMO_Ha", _D), ("HL_Gap_Ha", _D), ("PartialCharges", _S), ("num_atoms", _I), ("num_bonds", _I), ("mol_block", _S))]
    + [StructField(n, t) for n, t in (("energy_status", _S), ("filter_status", _S), ("filter_reason", _S), ("CanonicalSMILES", _S), ("dedup_status", _S), ("dedup_reason", _S), ("ICONF", _I), ("stereo_status", _S), ("reorder_status", _S), ("validate_status", _S), ("validate_errors", _S))]
)

MAIN = StructType([StructField("Zinc_id", _S), StructField("smile", _S), *[StructField(n, _D) for n in ("Internal_E(0K)", "HOMO", "LUMO", "HL_gap")], StructField("energy_status", _S)])
XYZ = StructType([StructField("Zinc_id", _S), StructField("atom", _S), *[StructField(n, _D) for n in ("final_x", "final_y", "final_z", "charge")]])
BOND = StructType([StructField("Zinc_id", _S), StructField("atom1", _I), StructField("atom2", _I)])

# Element types of the composition fit.
FIT_ELEMENTS = ("H", "C", "N", "O", "F", "P", "S", "Cl", "Br", "I")

# Checks of each filter preset.
PRESETS = {
    "neutral_closed_shell": ("charge", "zwitterion", "radicals"),
    "neutral": ("charge",),
    "none": (),
}
