"""Nearest neighbours by Tanimoto similarity of bit fingerprints.

The query set is stated (ids divisible by a number, or rows marked by a column) and is compared with all rows in blocks: the queries of a block,
bounded in number, go to every partition, which keeps the best match of each query. Rows are sorted by the number of
bits within a batch, and since T <= min(a, b) / max(a, b), only those that can still beat the best so far are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.session import ensure_checkpoint_dir, materialise

#: Queries that travel at once: 16,384 of 256 bytes are four megabytes.
BLOCK = 16_384


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).view(np.uint64)


def nearest_neighbours(df: DataFrame, row_id: str, bits: str, divisor: int = 20, block: int = BLOCK, asks: str | None = None) -> DataFrame:
    """query_id, max_tanimoto: for every row whose id is divisible by `divisor`, its largest similarity to another row.

    `asks` names a boolean column that marks the queries instead. Rows are told apart by id, so repeats of a query score 1. Rows without fingerprint are neither query nor match. Two
    fingerprints without any bit have similarity 0. With fewer than two fingerprints the result is null for each query.
    """
    # Written once: every block of queries reads all fingerprints again.
    asking = F.col(row_id).cast("bigint") % divisor == 0 if asks is None else F.col(asks)
    # The filter comes after: before, it would be pushed below what makes the fingerprints and make them twice.
    rows = materialise(df.select(F.col(row_id).cast("bigint").alias("id"), F.col(bits).alias("bits"), asking.alias("asks"))).filter("bits is not null")
    asked = rows.filter("asks")
    parts = max(1, -(-asked.count() // block))
    spark = df.sparkSession
    table = f"{ensure_checkpoint_dir(spark)}/nearest-{uuid4().hex}"
    for p in range(parts):
        # A hash block holds about `block` queries. Only these come to the driver, and their answers go to the table
        # before the next ones do, so neither grows with the number of queries.
        some = asked.filter(F.pmod(F.xxhash64("id"), F.lit(parts)) == p).toArrow()
        if some.num_rows:
            ids, queries = some.column("id").to_numpy(), _matrix(some.column("bits").combine_chunks())
            found = rows.mapInArrow(_matcher(ids, queries), "query_id bigint, best double")
            found.groupBy("query_id").agg(F.max("best").alias("max_tanimoto")).write.mode("append").parquet(table)
    queries = asked.select(F.col("id").alias("query_id"))
    best = spark.createDataFrame([], "query_id bigint, max_tanimoto double")
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        best = spark.read.schema(best.schema).parquet(table)
    return queries.join(best, "query_id", "left")


def _matcher(ids: np.ndarray, queries: np.ndarray):  # noqa: ANN202
    sizes = np.bitwise_count(queries).sum(1).astype(np.int64)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(len(ids), -1.0)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, rows = batch.column("id").to_numpy(zero_copy_only=False), _matrix(batch.column("bits"))
            count = np.bitwise_count(rows).sum(1).astype(np.int64)
            order = np.argsort(count, kind="stable")
            own, rows, count = own[order], rows[order], count[order]
            for q in range(len(ids)):
                a, t = sizes[q], max(best[q], 0.0)
                lo = np.searchsorted(count, int(np.ceil(a * t - 1e-9)))
                hi = np.searchsorted(count, int(np.floor(a / t + 1e-9)), "right") if t > 0 else len(count)
                if lo >= hi:
                    continue
                both = np.bitwise_count(rows[lo:hi] & queries[q]).sum(1).astype(np.int64)
                either = count[lo:hi] + a - both
                sims = np.where(either > 0, both / np.maximum(either, 1), 0.0)
                sims[own[lo:hi] == ids[q]] = -1.0
                best[q] = max(best[q], sims.max())
        seen = best >= 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[seen]), pa.array(best[seen])], names=["query_id", "best"])

    return match
