"""Arrow functions over columns: the chemistry kernel and Python's number text, in batches."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable
from functools import lru_cache
from inspect import signature
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from corundum.functions import chem
from corundum.functions.v2000 import is_block
from corundum.schema import FIT_ELEMENTS

_ARROW = {StringType: pa.string(), IntegerType: pa.int32(), LongType: pa.int64(), DoubleType: pa.float64(), BooleanType: pa.bool_()}


def arrow_type(t: DataType) -> pa.DataType:
    if isinstance(t, ArrayType):
        return pa.list_(arrow_type(t.elementType))
    if isinstance(t, StructType):
        return pa.struct([pa.field(f.name, arrow_type(f.dataType)) for f in t.fields])
    return _ARROW[type(t)]


def by_row(function: Callable, returns: DataType) -> Callable:
    """An Arrow function that applies a Python one to the values of each row."""
    kind = arrow_type(returns)

    def run(*columns: pa.Array) -> pa.Array:
        return pa.array([function(*(v.as_py() for v in row)) for row in zip(*columns, strict=True)], kind)

    if returns is None:
        raise ValueError("a type is needed")
    # Arrow functions take a fixed number of columns.
    one, two, three = (lambda a: run(a)), (lambda a, b: run(a, b)), (lambda a, b, c: run(a, b, c))
    return {1: F.arrow_udf(_typed(one, 1), returns), 2: F.arrow_udf(_typed(two, 2), returns), 3: F.arrow_udf(_typed(three, 3), returns)}[len(signature(function).parameters)]


def _typed(function: Callable, n: int) -> Callable:
    function.__annotations__ = {**dict.fromkeys("abc"[:n], pa.Array), "return": pa.Array}
    return function


FACTS = StructType(
    [
        StructField("canonical", StringType()), StructField("flat", StringType()), StructField("mirrored", StringType()), StructField("has_stereo", BooleanType()),
        StructField("net_charge", IntegerType()), StructField("charged_atoms", IntegerType()), StructField("radicals", IntegerType()), StructField("fragments", IntegerType()),
        StructField("MolWt", DoubleType()), StructField("TPSA", DoubleType()), StructField("nrot", IntegerType()), StructField("num_atoms", IntegerType()), StructField("logP", DoubleType()),
    ]
)

STATE = StructType([StructField("net_charge", IntegerType()), StructField("charged_atoms", IntegerType()), StructField("radicals", IntegerType())])

#: What the stages need of a block. texts_missing: why there is no canonical text.
RECORD = StructType(
    [
        StructField("canonical", StringType()), StructField("mirrored", StringType()), StructField("has_stereo", BooleanType()),
        StructField("net_charge", IntegerType()), StructField("charged_atoms", IntegerType()), StructField("radicals", IntegerType()), StructField("fragments", IntegerType()),
        StructField("num_atoms", IntegerType()), StructField("num_bonds", IntegerType()), StructField("heavy_atoms", IntegerType()),
        StructField("elements", ArrayType(StringType())), StructField("counts", ArrayType(IntegerType())), StructField("texts_missing", StringType()),
    ]
)


def _facts(smiles: str | None) -> dict | None:
    found = None if smiles is None else chem.smiles_facts(smiles)
    return None if found is None else dict(zip(FACTS.names, found, strict=True))


def _state(smiles: str | None) -> dict | None:
    found = None if smiles is None else chem.smiles_state(smiles)
    return None if found is None else dict(zip(STATE.names, found, strict=True))


def _record(block: str | None, smiles: str | None) -> dict | None:
    found = chem.block_texts(block, smiles)
    if found is None:
        return None
    canonical, mirrored, has, net, charged, radicals, fragments, symbols, bonds, why = found
    values = (canonical, mirrored, has, net, charged, radicals, fragments, len(symbols), bonds, sum(s != "H" for s in symbols), sorted(set(symbols)), [symbols.count(e) for e in FIT_ELEMENTS], why)
    return dict(zip(RECORD.names, values, strict=True))


def _geometry_record(block: str | None, smiles: str | None, charge: int | None) -> dict | None:
    own = _record(block, smiles)
    mol = chem.bonds_from_geometry(block, charge or 0) if own else None
    if mol is None:
        return own
    net, charged = chem.charges(mol)
    return own | {"net_charge": net, "charged_atoms": charged, "radicals": chem.radicals(mol), "fragments": chem.fragments(mol)}


def _flat(smiles: str | None) -> str | None:
    return None if smiles is None else chem.flat_smiles(smiles)


STEREO = StructType([StructField("canonical", StringType()), StructField("mirrored", StringType()), StructField("has_stereo", BooleanType())])


@lru_cache(maxsize=20_000)
def _stereo(smiles: str | None) -> dict | None:
    # Without a mark of handedness neither text is needed.
    mol = chem.parse_smiles(smiles, aromatize="@" in (smiles or ""))
    if mol is None:
        return None
    canonical, _, mirrored, has = chem.texts(mol) if "@" in smiles else (None, None, None, False)
    return {"canonical": canonical, "mirrored": mirrored, "has_stereo": has}


def _bits(smiles: str | None) -> list[int] | None:
    mol = chem.parse_smiles(smiles)
    return None if mol is None or not mol.atoms else chem.fingerprint(mol)


FRAME = StructType([StructField("n", IntegerType()), StructField("formula", StringType()), StructField("cnso", IntegerType()), StructField("lines", StringType())])
DESCRIPTORS = StructType([StructField(n, DoubleType()) for n in ("MolWt", "TPSA", "logP")] + [StructField(n, IntegerType()) for n in ("nrot", "num_atoms", "fragments")])


def _block_frame(block: str | None) -> dict | None:
    if not is_block(block):
        return None
    lines = block.split("\n")
    atoms = lines[4 : 4 + int(lines[3][:3])]
    if not atoms:
        return None
    symbols = [x[31:34].strip() for x in atoms]
    kinds = sorted(set(symbols))
    formula = "".join(f"{e}{k if k > 1 else ''}" for e, k in zip(kinds, map(symbols.count, kinds), strict=True))
    text = "".join([f"{s:2s}  {float(x[:10]):.6f}  {float(x[10:20]):.6f}  {float(x[20:30]):.6f}\n" for s, x in zip(symbols, atoms, strict=True)])
    return {"n": len(atoms), "formula": formula, "cnso": sum(s in ("C", "N", "S", "O") for s in symbols), "lines": text}


def _frame_text(block: str | None, smiles: str | None, head: dict) -> str | None:
    f = _block_frame(block)
    if f is None:
        return None
    d = _descriptors(smiles) or {}
    shown = lambda v, missing="": missing if v is None else str(v)
    two = lambda v: "" if v is None else f"{v:.2f}"
    pairs = (
        ("SourceID", shown(head["SourceID"])), ("CompoundID", shown(head["CompoundID"])), ("Formula", f["formula"]), ("Nat", f["n"]), ("CNSO", f["cnso"]),
        ("chrg", shown(head["FormalCharge"], "0")), ("mult", shown(head["Multiplicity"], "1")), ("E", shown(head["Energy_Ha"])), ("fmax", ""), ("Family", head["family"]),
        ("smiles", shown(smiles)), ("tpsa", two(d.get("TPSA"))), ("logp", two(d.get("logP"))), ("nrot", shown(d.get("nrot"))), ("nfrag", 1), ("iconf", shown(head["ICONF"], "1")),
    )
    return f"{f['n']}\n" + ",".join(f"{k},{v}" for k, v in pairs) + "\n" + f["lines"]


@lru_cache(maxsize=20_000)
def _descriptors(smiles: str | None) -> dict | None:
    mol = chem.parse_smiles(smiles or None)
    if mol is None:
        return None
    return {"MolWt": chem.weight(mol), "TPSA": chem.polar_surface(mol), "logP": chem.partition(mol), "nrot": chem.rotatable(mol), "num_atoms": len(mol.atoms), "fragments": chem.fragments(mol)}


def _reordered(block: str | None, smiles: str | None) -> str | None:
    return chem.reorder_block(block, smiles)


def _reordered_by_rank(block: str | None, smiles: str | None) -> str | None:
    return chem.reorder_block(block, smiles, by_rank=True)


def external_order(command: tuple[str, ...], seconds: float = 120.0) -> Callable:
    """A function of a block: atoms in the order in which an external program writes them.

    The program gets the name of a frame file as its last argument and rewrites that file. No order comes out (null)
    where it fails, takes longer than `seconds`, is not installed, or changes the elements. The file lives on the
    worker only as long as the call.
    """

    def run(block: str | None) -> str | None:
        frame = _block_frame(block)
        if frame is None:
            return None
        with tempfile.TemporaryDirectory() as folder:
            path = Path(folder, "atoms.xyz")
            path.write_text(f"{frame['n']}\n\n{frame['lines']}")
            try:
                if subprocess.run([*command, str(path)], capture_output=True, timeout=seconds, check=False).returncode:
                    return None
                lines = path.read_text().split("\n")
                return chem.order_by_elements(block, [x.split()[0] for x in lines[2 : 2 + int(lines[0])]])
            except (OSError, subprocess.TimeoutExpired, ValueError, IndexError):
                return None

    return by_row(run, StringType())


def _number_text(value: float | None) -> str | None:
    return None if value is None else str(value)


def fixed_text(places: int) -> Callable:
    """Python's fixed-point text of a double: ties on the binary value, as format() does."""

    def text(value: float | None) -> str | None:
        return None if value is None else f"{value:.{places}f}"

    return by_row(text, StringType())


#: Facts of a SMILES text; null for null and unreadable ones.
smiles_facts = by_row(_facts, FACTS)
#: Charges and radicals alone.
smiles_state = by_row(_state, STATE)
#: Canonical and mirrored text and handedness of a SMILES text; texts only where there is handedness.
smiles_stereo = by_row(_stereo, STEREO)
#: Canonical text without stereo of a SMILES text, and of a V2000 block; null for unreadable ones.
flat_smiles = by_row(_flat, StringType())
block_flat = by_row(chem.block_flat, StringType())
#: (block, SMILES): facts of a V2000 block from its own bonds, charges and coordinates; null for no valid block.
record_facts = by_row(_record, RECORD)
#: (block, SMILES, charge): the same with bonds and charges from coordinates and the total charge, where they can be worked out.
geometry_facts = by_row(_geometry_record, RECORD)
#: 2048-bit circular fingerprint of a SMILES text as 32 words.
fingerprint = by_row(_bits, ArrayType(LongType()))
#: Atom count, formula, CNSO and atom lines of a frame from a valid block with atoms, else null.
block_frame = by_row(_block_frame, FRAME)
#: (block, SMILES, header fields): the whole frame of a valid block with atoms, else null.
frame_text = by_row(_frame_text, StringType())
#: Weight, polar surface, logP, rotatable bonds, atoms and fragments of a SMILES text; null for null, empty and unreadable ones.
smiles_descriptors = by_row(_descriptors, DESCRIPTORS)
#: Python's shortest text of a double.
number_text = by_row(_number_text, StringType())
#: (block, SMILES): a block in canonical atom order.
reorder_block = by_row(_reordered, StringType())
reorder_block_by_rank = by_row(_reordered_by_rank, StringType())
