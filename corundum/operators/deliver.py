"""Training-ready frames and structure text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corundum.functions.arrow import block_frame, by_row, frame_text
from corundum.functions.v2000 import formula

CNSO = ("C", "N", "S", "O")
#: Largest number of atoms, and of bonds, that a V2000 counts line can show.
V2000_MOST = 999


def with_composition(df: DataFrame, symbols: Column) -> DataFrame:
    """df with Formula (alphabetical), Nat and CNSO of a list of element symbols."""
    return df.withColumns({"Formula": formula(symbols), "Nat": F.size(symbols), "CNSO": F.size(F.filter(symbols, lambda s: s.isin(*CNSO)))})


def frames(batch: DataFrame, family: str = "QM40") -> DataFrame:
    """row_seq and `frame`: atom count, a line of key,value pairs, one line for each atom.

    Rows whose block is not valid or has no atom line are left out. Missing values are shown empty, except the charge (0),
    multiplicity and iconf (1). tpsa, logp and nrot come from the CanonicalSMILES. One Arrow function writes the frame.
    """
    head = F.struct("SourceID", "CompoundID", "FormalCharge", "Multiplicity", "Energy_Ha", "ICONF", F.lit(family).alias("family"))
    # A frame that is missing is never written, and a filter on it would run the function twice if it were pushed below.
    return batch.select("row_seq", F.explode_outer(F.array(frame_text(F.col("mol_block"), F.col("CanonicalSMILES"), head))).alias("frame")).filter("frame is not null")


def xyz_text(block: Column) -> Column:
    """Element and coordinates of each atom line of a valid block, one a line, six decimals."""
    return block_frame(block)["lines"]


def _block(title: str | None, molecule: dict | None) -> str | None:
    if molecule is None or molecule["symbols"] is None:
        return None
    s, xyz, pairs = molecule["symbols"], molecule["coordinates"], molecule["bonds"] or []
    if len(s) > V2000_MOST or len(pairs) > V2000_MOST or any(x is None for x in xyz):
        return None
    lines = [title or "", "  corundum", "", f"{len(s):3d}{len(pairs):3d}  0  0  0  0  0  0  0  0999 V2000"]
    lines += [f"{xyz[3 * i]:10.4f}{xyz[3 * i + 1]:10.4f}{xyz[3 * i + 2]:10.4f} {e:<3s} 0  0  0  0  0  0  0  0  0  0  0  0" for i, e in enumerate(s)]
    lines += [f"{p['a']:3d}{p['b']:3d}  1  0" for p in pairs]
    return "\n".join([*lines, "M  END"])


def build_block(title: Column, symbols: Column, coordinates: Column, bonds: Column) -> Column:
    """A V2000 block of single bonds; null beyond its 999 atoms or bonds, or where a coordinate is missing."""
    return by_row(_block, StringType())(title, F.struct(symbols.alias("symbols"), coordinates.alias("coordinates"), bonds.alias("bonds")))


def block_refusal(symbols: Column, coordinates: Column, bonds: Column) -> Column:
    """Why build_block gives no block, else null."""
    few = (F.size(symbols) <= V2000_MOST) & (F.coalesce(F.size(bonds), F.lit(0)) <= V2000_MOST)
    return F.when(symbols.isNull() | coordinates.isNull(), "no atoms").when(~few, f"beyond {V2000_MOST} atoms or bonds").when(F.exists(coordinates, lambda x: x.isNull()), "a coordinate is missing")


def sdf_record(block: Column, tags: dict[str, Column]) -> Column:
    """A record of a structure file: the block, then each tag that is not null, then $$$$."""
    shown = [F.when(v.isNotNull(), F.concat(F.lit(f"> <{k}>\n"), v.cast("string"), F.lit("\n\n"))) for k, v in tags.items()]
    return F.concat(block, F.lit("\n"), F.concat_ws("", *shown), F.lit("$$$$\n"))
