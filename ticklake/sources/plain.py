"""The un-keyed lake in place: a table over it, and files whose types drifted.

``{root}/{subdir}/{pair}/{yyyy-MM-dd}/{HH}/…`` has no ``key=value`` directories, so
Spark finds no partitions in it. ``create_plain_table`` maps each directory to a
partition of a catalog table, so range reads prune by pair, date and hour without
a copy. ``read_drifted`` reads a tree whose files were written with inferred types:
footers tell the physical schemas, each kind of file is read with its own and cast.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.schema import LAKE_PARTITION_COLS, LAKE_PARTITIONS, TRADE_V1
from ticklake.session import configure, scratch_path
from ticklake.sources.lake import unkeyed_columns

_ADD_AT_ONCE = 500  # partitions in one ALTER TABLE
_DATE, _HOUR = re.compile(r"\d{4}-\d{2}-\d{2}"), re.compile(r"\d{2}")


def plain_directories(spark: SparkSession, root: str, subdir: str = "trades") -> dict[tuple[str, str, int], str]:
    """(pair, date, hour) -> directory, by listing directories (no file is opened)."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{subdir}/*/*/*")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    out = {}
    for status in found:
        path = status.getPath()
        pair, date, hour = path.getParent().getParent().getName(), path.getParent().getName(), path.getName()
        if status.isDirectory() and _DATE.fullmatch(date) and _HOUR.fullmatch(hour):
            out[pair, date, int(hour)] = path.toString()
    return out


def create_plain_table(spark: SparkSession, root: str, subdir: str = "trades", db: str = "ext", name: str = "trades_plain") -> str:
    """(Re)create ``db.name`` over the un-keyed tree, one partition per directory.

    The definition is dropped first, never the data. A missing database is
    created under ``root/_catalog``.
    """
    from ticklake.sources.catalog import ensure_namespaces

    configure(spark)
    if not spark.catalog.databaseExists(db):
        ensure_namespaces(spark, [db], location_root=f"{root.rstrip('/')}/_catalog")
    spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (*TRADE_V1.fields, *LAKE_PARTITIONS.fields))
    spark.sql(
        f"CREATE TABLE `{db}`.`{name}` ({cols}) USING PARQUET PARTITIONED BY ({', '.join(LAKE_PARTITION_COLS)}) "
        f"LOCATION {_quoted(f'{root.rstrip('/')}/{subdir}')}"
    )
    sync_plain_table(spark, f"{db}.{name}", root, subdir)
    return f"{db}.{name}"


def sync_plain_table(spark: SparkSession, table: str, root: str, subdir: str = "trades") -> tuple[int, int]:
    """Add new directories as partitions and drop those that are gone; (added, dropped).

    New files in a known directory need no change but the cache refresh.
    """
    there = plain_directories(spark, root, subdir)
    known = {_spec_of(r[0]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}  # one row per directory
    new, gone = sorted(set(there) - known), sorted(known - set(there))
    for at in range(0, len(new), _ADD_AT_ONCE):
        parts = " ".join(f"PARTITION ({_spec(k)}) LOCATION {_quoted(there[k])}" for k in new[at : at + _ADD_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    for at in range(0, len(gone), _ADD_AT_ONCE):
        parts = ", ".join(f"PARTITION ({_spec(k)})" for k in gone[at : at + _ADD_AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
    spark.catalog.refreshTable(table)
    return len(new), len(gone)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(key: tuple[str, str, int]) -> str:
    pair, date, hour = key
    return f"pair={_quoted(pair)}, trade_date='{date}', hour={hour}"


def _spec_of(shown: str) -> tuple[str, str, int]:
    """``pair=…/trade_date=…/hour=…`` as SHOW PARTITIONS writes it, with %XX escapes."""
    from urllib.parse import unquote

    pair, date, hour = (unquote(part.split("=", 1)[1]) for part in shown.split("/"))
    return pair, date, int(hour)


# -- drifted types -------------------------------------------------------------


def physical_schemas(spark: SparkSession, path: str) -> DataFrame:
    """``(path, schema)`` of every Parquet file below ``path``; schema as Spark's JSON.

    Runs in tasks; only the footer of a file (its length stands in the last
    bytes) is handed to Python. Meant for the small files of a flushing writer:
    Spark reads each file once to get at its end.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(path).select("path", "length", "content")
    )
    at = lambda back: F.expr(f"hex(substring(content, cast(length as int) - {back}, 1))")
    size = F.conv(F.concat(at(4), at(5), at(6), at(7)), 16, 10).cast("int")
    footer = F.substring(F.col("content"), F.col("length").cast("int") - 7 - size, size + 8)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            schemas = [from_arrow_schema(pq.read_schema(pa.BufferReader(b))).json() for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(schemas, pa.string())], names=["path", "schema"])

    return found.select("path", footer.alias("footer")).mapInArrow(parse, "path string, schema string")


def read_drifted(spark: SparkSession, root: str, subdir: str = "trades") -> DataFrame:
    """The un-keyed tree, whatever types its files were written with.

    Files are grouped by physical schema; each group is read with its own and
    cast to trade_v1 (a value that does not cast is null, as is a column that a
    file lacks; other columns are dropped). Columns as of ``read_unkeyed``.
    """
    configure(spark)
    at = scratch_path(spark, "schemas")
    physical_schemas(spark, f"{root.rstrip('/')}/{subdir}").write.parquet(at)
    kinds: dict[str, list[str]] = {}
    for path, schema in spark.read.parquet(at).collect():  # the manifest: one row per file
        kinds.setdefault(schema, []).append(path)
    out = None
    for schema, paths in sorted(kinds.items()):
        have = StructType.fromJson(json.loads(schema))
        part = spark.read.schema(have).parquet(*paths)
        part = unkeyed_columns(part.select(*(_cast(f, have) for f in TRADE_V1.fields), "_metadata"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return unkeyed_columns(spark.read.schema(TRADE_V1).option("recursiveFileLookup", "true").parquet(f"{root.rstrip('/')}/{subdir}"))
    return out


def _cast(field, have: StructType) -> Column:
    if field.name not in have.names:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(field.name).try_cast(field.dataType).alias(field.name)
