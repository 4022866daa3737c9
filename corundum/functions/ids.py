"""Normal forms of the identifiers and labels that arrive in several spellings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Largest number of digits that is sure to fit a bigint.
MAX_DIGITS = 18


def readable_compound(compound_id: Column) -> Column:
    """The 32 lower-case hex digits that a spelling of a CompoundID shows, else null.

    White space, hyphens and braces may stand anywhere between the digits; anything else makes it unreadable.
    """
    hexes = F.lower(F.regexp_replace(compound_id, r"[\s\p{Z}\-{}]", ""))
    return F.when(hexes.rlike(r"\A[0-9a-f]{32}\z"), hexes)


def smiles_compound(canonical_smiles: Column) -> Column:
    """MD5 of the canonical SMILES' UTF-8 bytes; null stays null, and so does a blank text, which names no structure."""
    return F.when(F.trim(canonical_smiles) != "", F.md5(canonical_smiles.cast("binary")))


def compound_of(compound_id: Column, canonical_smiles: Column) -> Column:
    """The compound of a record: its readable CompoundID, else the MD5 of its CanonicalSMILES, else null."""
    return F.coalesce(readable_compound(compound_id), smiles_compound(canonical_smiles))


def bare(text: Column) -> Column:
    """Lower case without blanks, tabs, hyphens and underscores: equal for two spellings of one label."""
    return F.lower(F.regexp_replace(text, r"[\s\p{Z}_\-]+", ""))


def label(text: Column) -> Column:
    """A label in lower case, its words joined by underscores; blank becomes null."""
    low = F.regexp_replace(F.lower(text), r"\A[\s\p{Z}_\-]+|[\s\p{Z}_\-]+\z", "")
    return F.nullif(F.regexp_replace(low, r"[\s\p{Z}_\-]+", "_"), F.lit(""))


def _alnum(zinc_id: Column) -> Column:
    return F.upper(F.regexp_replace(zinc_id, r"[^0-9A-Za-z]", ""))


def zinc_number(zinc_id: Column) -> Column:
    """The number of a molecule id (bigint), whatever case, blanks, separators and leading zeros it is written with.

    Null for null and blank ids, and for ids that are not ZINC and a number (see zinc_other).
    """
    digits = F.regexp_extract(_alnum(zinc_id), r"\AZINC0*([0-9]+)\z", 1)
    return F.when((digits != "") & (F.length(digits) <= MAX_DIGITS), digits.cast("bigint"))


def zinc_other(zinc_id: Column) -> Column:
    """Upper-case letters and digits of an id that is neither blank nor ZINC and a number of up to 18 digits; else null."""
    return F.when(zinc_number(zinc_id).isNull(), F.nullif(_alnum(zinc_id), F.lit("")))


def zinc_name(zinc_id: Column) -> Column:
    """One text for all spellings of a molecule id: ZINC and 12 digits, else its upper-case letters and digits; null for null and blank ids."""
    # Most ids are written as they should be; the rules run for the others only.
    plain = zinc_id.rlike(r"\AZINC[0-9]{12}\z")
    return F.when(plain, zinc_id).otherwise(F.coalesce(zinc_text(zinc_number(zinc_id)), zinc_other(zinc_id)))


def zinc_text(number: Column) -> Column:
    """ZINC and at least 12 digits."""
    return F.concat(F.lit("ZINC"), F.when(F.length(number.cast("string")) >= 12, number.cast("string")).otherwise(F.lpad(number.cast("string"), 12, "0")))
