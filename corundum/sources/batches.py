"""Batch directories and delimited tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from corundum.schema import BATCH
from corundum.session import join_checked


def read_batches(spark: SparkSession, directory: str, schema: StructType = BATCH, order: str = "row_seq") -> DataFrame:
    """A directory of Parquet batches under the fixed schema; columns that a file lacks are null, further ones are left out.

    Batches of one column may have been written as int or as double, as their values were; ints are therefore read as
    doubles and cast, NaN to null. A null or missing `order` is filled from the file's place in the name order and the
    row's place in the file.
    """
    wide = StructType([StructField(f.name, DoubleType() if isinstance(f.dataType, IntegerType) else f.dataType, True) for f in schema.fields])
    found = spark.read.schema(wide).parquet(directory)
    place = F.lit(None).cast("bigint")
    if any(f.name == order for f in schema.fields):
        # One row for each file goes through one task; the rows themselves are joined by name.
        names = found.select(F.col("_metadata.file_name").alias("__file")).distinct()
        at = names.withColumn("__place", F.row_number().over(W.orderBy("__file")).cast("bigint"))
        found = join_checked(found.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__index")), at, ["__file"])
        place = F.shiftleft(F.col("__place"), 40) + F.col("__index")

    def column(f: StructField):  # noqa: ANN202
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, IntegerType):
            c = F.when(~F.isnan(c), c).cast("int")
        return (F.coalesce(c, place) if f.name == order else c).alias(f.name)

    return found.select(*[column(f) for f in schema.fields])


def read_csv(spark: SparkSession, path: str, schema: StructType, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """A delimited file with a header under a fixed schema; a field of the wrong type is null.

    `order`: the file's columns, if they don't come in the order of the schema.
    """
    if order is not None:
        schema = StructType([schema[c] for c in order])
    out = spark.read.csv(path, header=True, schema=schema, multiLine=False, enforceSchema=False)
    return out if limit is None else out.limit(limit)


def with_file_order(df: DataFrame, name: str) -> DataFrame:
    """df, fresh from a file, with a column that sorts its rows as the files have them: file, piece of it, place in the piece.

    Tasks get the largest pieces first, so a growing number alone would not do.
    """
    return df.withColumn(name, F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row")))
