"""Input-contract validation over text tags: errors, warnings and `passed` for every record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corundum.schema import OPTIONAL, RECOMMENDED, REQUIRED

# Number texts as the contract reads them: underscores between digits are fine, a trailing d or f is not.
_INT = r"\A\s*[+-]?[0-9]+(?:_[0-9]+)*\s*\z"
_FLOAT = r"(?i)\A\s*[+-]?(?:(?:[0-9]+(?:_[0-9]+)*(?:\.(?:[0-9]+(?:_[0-9]+)*)?)?|\.[0-9]+(?:_[0-9]+)*)(?:e[+-]?[0-9]+(?:_[0-9]+)*)?|nan|inf|infinity)\s*\z"


def _wrong(name: str, kind: str, value: Column) -> Column:
    """The message for a present value of the wrong kind, else null."""
    if name == "Multiplicity":
        positive = F.regexp_replace(value, r"[\s_+]", "").rlike(r"\A0*[1-9][0-9]*\z")
        return F.when(~value.rlike(_INT), F.concat(F.lit("Multiplicity: '"), value, F.lit("' is not parseable as integer"))).when(
            ~positive, F.concat(F.lit("Multiplicity: "), value, F.lit(" is not a positive integer"))
        )
    if kind == "int":
        return F.when(~value.rlike(_INT), F.concat(F.lit(f"{name}: '"), value, F.lit("' is not parseable as integer")))
    if kind == "float":
        return F.when(~value.rlike(_FLOAT), F.concat(F.lit(f"{name}: '"), value, F.lit("' is not parseable as float")))
    return F.lit(None).cast("string")


def validate_contract(
    df: DataFrame, required: Mapping[str, str] = REQUIRED, recommended: Mapping[str, str] = RECOMMENDED, optional: Mapping[str, str] = OPTIONAL,
    strict: bool = True, parsed: Column | None = None,
) -> DataFrame:
    """df with `errors`, `warnings` (arrays of text) and `passed`.

    A null tag is missing. A missing required tag is an error, or a warning if not strict; a missing recommended or
    optional one a warning. A value of the wrong kind is an error in either mode, also of an optional tag. `parsed` false
    stands for a record whose structure can't be read: its only error. Columns beyond the contract pass through.
    """
    errors, warnings = [], []
    for tags, status in ((required, "required"), (recommended, "recommended"), (optional, "optional")):
        for name, kind in tags.items():
            value = F.col(name).cast("string")
            missing = F.when(value.isNull(), F.lit(f"{name}: missing ({status})"))
            (errors if status == "required" and strict else warnings).append(missing)
            errors.append(F.when(value.isNotNull(), _wrong(name, kind, value)))
    some = lambda messages: F.filter(F.array(*messages), lambda m: m.isNotNull())
    found, warned = some(errors), some(warnings)
    if parsed is not None:
        found = F.when(parsed, found).otherwise(F.array(F.lit("structure: could not parse molecule")))
        warned = F.when(parsed, warned).otherwise(F.array().cast("array<string>"))
    return df.withColumns({"errors": found, "warnings": warned}).withColumn("passed", F.size("errors") == 0)
