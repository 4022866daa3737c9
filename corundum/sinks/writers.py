"""Writers: Parquet batches, structure files, frames, delimited statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import number_text
from corundum.operators.deliver import frames, sdf_record
from corundum.schema import OPTIONAL, RECOMMENDED, REJECT_TAGS, REQUIRED


def write_batches(df: DataFrame, directory: str, rows_per_file: int = 5000, order: str = "row_seq") -> None:
    """Parquet batches of at most rows_per_file rows in the order of row_seq, zstandard compressed; replaces what was there."""
    df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(directory)


def _write_text(df: DataFrame, directory: str) -> None:
    """Texts that end their own lines."""
    df.select(F.regexp_replace("value", r"\n\z", "")).write.mode("overwrite").text(directory)


def write_records(records: DataFrame, directory: str) -> None:
    """Structure records that are texts already, in a column `value`."""
    _write_text(records, directory)


def write_sdf(df: DataFrame, directory: str, tags: tuple[str, ...] = tuple({**REQUIRED, **RECOMMENDED, **OPTIONAL})) -> None:
    """Structure records of every row with a block, with the tags that are not null."""
    text = df.filter("mol_block is not null").select(sdf_record(F.col("mol_block"), {t: F.col(t) for t in tags if t in df.columns}).alias("value"))
    _write_text(text, directory)


def reject_records(df: DataFrame, reason: str) -> DataFrame:
    """`value`: a structure record of each row with a reason and a block: fixed tags first, then further columns, then reject_reason."""
    skip = {"mol_block", reason, "row_seq"}
    rest = [f.name for f in df.schema.fields if f.name not in skip and f.name not in REJECT_TAGS and f.dataType.typeName() not in ("array", "map", "struct")]
    shown = lambda t: number_text(F.col(f"`{t}`")) if df.schema[t].dataType.typeName() == "double" else F.col(f"`{t}`")
    tags = {t: shown(t) for t in (*[t for t in REJECT_TAGS if t in df.columns], *rest)} | {"reject_reason": F.col(reason)}
    return df.filter(F.col(reason).isNotNull() & F.col("mol_block").isNotNull()).select(sdf_record(F.col("mol_block"), tags).alias("value"))


def write_rejects(df: DataFrame, directory: str, reason: str) -> None:
    _write_text(reject_records(df, reason), directory)


def write_frames(batch: DataFrame, directory: str, family: str = "QM40") -> None:
    """One text file of frames for each partition."""
    _write_text(frames(batch, family).select(F.col("frame").alias("value")), directory)


def write_csv(df: DataFrame, directory: str) -> None:
    """Delimited text with a header; null is empty, NaN is nan."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("nanValue", "nan").csv(directory)
