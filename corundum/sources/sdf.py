"""Structure files (SDF) as DataFrames: one record, one row."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.v2000 import block_lines, counts, cut_block, is_block
from corundum.schema import OPTIONAL, RECOMMENDED, REQUIRED

SEPARATOR = "$$$$"
#: Bits of row_seq for the place in a file; the file's rank stands above them.
PLACE_BITS = 43


def _path(text: str) -> str:
    return re.sub(r"\A[A-Za-z0-9+.\-]+:/*", "/", unquote(text))


def read_sdf(spark: SparkSession, path: str) -> DataFrame:
    """row_seq, record, mol_block, parsed and tags (map) of every record; with either kind of line end.

    row_seq grows with the file's place in the order of paths and with the place in the file, however the files are cut
    into tasks: a record's number within its piece of the file is added to the byte at which the piece begins, and there
    are never more records than bytes. A record that does not parse keeps its raw text. The text after the last
    separator counts as a record unless it is blank.
    """
    raw = spark.read.text(path, lineSep=SEPARATOR)
    rank = {p: i for i, p in enumerate(sorted({_path(f) for f in raw.inputFiles()}))}
    raw = raw.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.regexp_replace("value", "\r\n", "\n").alias("record"))
    # What follows a separator is the rest of its line; a separator inside a line is not at a line's start.
    raw = raw.withColumn("record", F.regexp_replace("record", r"\A[ \t]*\n", "")).filter("trim(both ' \n\t\r' from record) <> ''").withColumn("mol_block", cut_block(F.col("record")))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, n = None, 0
        for batch in batches:
            places, parsed = [], []
            for file, at, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                piece, n = ((file, at), 0) if piece != (file, at) else (piece, n + 1)
                places.append((rank[_path(file)] << PLACE_BITS) + at + n)
                parsed.append(is_block(block))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), batch.column(2), batch.column(3), pa.array(parsed, pa.bool_())], names=["row_seq", "record", "mol_block", "parsed"])

    return raw.mapInArrow(number, "row_seq bigint, record string, mol_block string, parsed boolean").withColumn("tags", record_tags(F.col("record")))


def record_tags(record: Column) -> Column:
    """map<tag, value> of the data items behind a block; a repeated tag keeps its last value."""
    items = F.slice(F.split(F.substring_index(record, "M  END", -1), r"\n> *[^<\n]*<"), 2, 1 << 20)
    pair = lambda x: F.struct(F.substring_index(x, ">", 1).alias("key"), F.regexp_extract(x, r"(?s)\A[^>]*>[^\n]*\n(.*?)\n*\z", 1).alias("value"))
    pairs = F.transform(items, pair)
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["key"] == p["key"]))
    return F.map_from_entries(last)


def to_rows(records: DataFrame) -> DataFrame:
    """Records as batch rows: tags in typed columns (null where unusable), counts from the block, CompoundID null.

    Unknown tags stay in the map `tags`. Records that did not parse are left out.
    """
    atoms, bonds = counts(block_lines(F.col("mol_block")))
    cast = {"float": "double", "int": "int", "str": "string"}
    tag = lambda name: F.element_at("tags", F.lit(name))
    typed = {name: F.trim(tag(name)).try_cast(cast[kind]) if kind != "str" else tag(name) for name, kind in {**REQUIRED, **RECOMMENDED, **OPTIONAL}.items()}
    good = records.filter("parsed")
    return good.select("row_seq", F.lit(None).cast("string").alias("CompoundID"), *[c.alias(n) for n, c in typed.items()], atoms.alias("num_atoms"), bonds.alias("num_bonds"), "mol_block", "tags")


def tag_columns(records: DataFrame) -> DataFrame:
    """Records with the contract's tags as text columns, for contract validation."""
    return records.select("*", *[F.element_at("tags", F.lit(n)).alias(n) for n in {**REQUIRED, **RECOMMENDED, **OPTIONAL}])


def count_records(spark: SparkSession, path: str) -> int:
    """Records of a structure file; 0 for a path that does not exist."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return 0
    return read_sdf(spark, path).count()
