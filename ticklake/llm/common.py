"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import scratch_path

# Ids start far below this; rows without an id get a stand-in above it.
NO_ID = 1 << 62


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of
    recomputing (Python) stages, and no single copy lives on one machine.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(rows: int, per_task: int, least: int = 1) -> int:
    return max(least, -(-rows // per_task))


def held_out(id_col: Column) -> Column:
    """True for the documents that no model is fitted on (crc32 of the id mod 5 is 0)."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 == 0


def sampled(id_col: Column, share: float | Column) -> Column:
    """True for about ``share`` of the ids, by their hash on its full 63-bit range
    (a coarser one leaves no id of a small share)."""
    share = F.lit(share)
    return (share >= 1.0) | (F.shiftrightunsigned(F.xxhash64(id_col), 1) < share * float(1 << 63))


def map_rows(df: DataFrame, make: Callable[[], Callable[..., tuple]], schema: str) -> DataFrame:
    """Arrow-batched row function: ``make()`` runs once per task and returns
    ``f(*column values) -> tuple``; one output row per input row, in order."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            step = 512  # bounds the Python objects alive at once
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows = [f(*r) for r in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows), arrow)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
