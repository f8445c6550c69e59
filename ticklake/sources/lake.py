"""The trade lake: partitioned Parquet by pair / trade_date / hour.

Writes use Hive-style keyed directories (``pair=…/trade_date=…/hour=…``)
so reads get partition pruning; a reader for the un-keyed layout
``{root}/{subdir}/{pair}/{yyyy-MM-dd}/{HH}/…`` exposes the path segments
as typed columns. Local paths and object-store URIs (``s3a://`` …) are
the same code: the scheme of ``root`` selects the filesystem.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators.ingest import with_partition_values
from ticklake.schema import LAKE_PARTITION_COLS, LAKE_PARTITIONS, TRADE_V1, TRADE_V1_REQUIRED

LAKE_SCHEMA = T.StructType(TRADE_V1.fields + LAKE_PARTITIONS.fields)
# Rows per output file: bounds file size when one pair-hour is very hot.
MAX_RECORDS_PER_FILE = 5_000_000


def lake_frame(events: DataFrame) -> DataFrame:
    """trade_v1 rows + partition columns derived from the row values."""
    return with_partition_values(events.select(*TRADE_V1_REQUIRED))


def write_lake(events: DataFrame, root: str, mode: str = "append",
               num_partitions: int | None = None,
               max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Append trade_v1 rows to the lake (zstd Parquet, keyed directories).

    ``REBALANCE(pair, trade_date, hour)`` hashes rows to tasks by their
    directory; AQE then splits an oversized (hot pair-hour) partition
    across several tasks and merges small ones to the advisory size, so
    files stay few per directory without one task writing a hot hour.
    Rows are sorted by trade time within each file (tight row-group
    min/max for time-range reads). ``num_partitions`` sets the number of
    tasks before that split.
    """
    df = lake_frame(events)
    df = df.hint("rebalance", *([num_partitions] if num_partitions else []), *LAKE_PARTITION_COLS)
    (
        df.sortWithinPartitions(*LAKE_PARTITION_COLS, "trade_ts", "trade_id")
        .write.mode(mode)
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*LAKE_PARTITION_COLS)
        .parquet(root)
    )


def _as_dt(x) -> _dt.datetime:
    if isinstance(x, _dt.datetime):
        return x
    return _dt.datetime.fromisoformat(str(x))


def read_lake(spark: SparkSession, root: str, start=None, end=None, pairs=None) -> DataFrame:
    """Read trade_v1 rows (+ partition columns) with a fixed schema.

    ``start``/``end`` (UTC, end exclusive) become BOTH a row predicate on
    ``trade_ts`` and a partition predicate on ``trade_date``/``hour`` —
    Spark cannot derive the latter from the former, and without it every
    directory would be listed and scanned.
    """
    df = spark.read.schema(LAKE_SCHEMA).option("basePath", root).parquet(root)
    if pairs is not None:
        df = df.where(F.col("pair").isin(list(pairs)))
    if start is not None:
        s = _as_dt(start).replace(tzinfo=None)
        ms = int(s.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)
        d = F.lit(s.date())
        df = df.where(
            (F.col("trade_date") > d) | ((F.col("trade_date") == d) & (F.col("hour") >= F.lit(s.hour).cast("tinyint")))
        ).where(F.col("trade_ts") >= F.lit(ms))
    if end is not None:
        e = _as_dt(end).replace(tzinfo=None)
        ms = int(e.replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)
        d = F.lit(e.date())
        df = df.where(
            (F.col("trade_date") < d) | ((F.col("trade_date") == d) & (F.col("hour") <= F.lit(e.hour).cast("tinyint")))
        ).where(F.col("trade_ts") < F.lit(ms))
    return df


def read_trades(spark: SparkSession, root: str, start=None, end=None, layout: str = "keyed",
                subdir: str = "trades") -> DataFrame:
    """Trades of either lake layout: ``keyed`` (pruned range read) or
    ``plain`` (un-keyed directories; range applied as a row filter)."""
    if layout == "keyed":
        return read_lake(spark, root, start=start, end=end)
    if layout != "plain":
        raise ValueError(layout)
    df = read_unkeyed(spark, root, subdir, hours=_hours(start, end) if start is not None and end is not None else None)
    if start is not None:
        df = df.where(F.col("trade_ts") >= F.lit(_epoch_ms(start)))
    if end is not None:
        df = df.where(F.col("trade_ts") < F.lit(_epoch_ms(end)))
    return df


def _epoch_ms(x) -> int:
    return int(_as_dt(x).replace(tzinfo=_dt.timezone.utc).timestamp() * 1000)


def _hours(start, end) -> list[tuple[str, str]]:
    """(yyyy-MM-dd, HH) of every UTC hour that [start, end) touches."""
    at, out = _as_dt(start).replace(tzinfo=None, minute=0, second=0, microsecond=0), []
    while at < _as_dt(end).replace(tzinfo=None):
        out.append((at.strftime("%Y-%m-%d"), at.strftime("%H")))
        at += _dt.timedelta(hours=1)
    return out


# Un-keyed layout: {root}/{subdir}/{pair}/{yyyy-MM-dd}/{HH}/<file>
_UNKEYED = r"/([^/]+)/(\d{4}-\d{2}-\d{2})/(\d{2})/[^/]+$"


def read_unkeyed(spark: SparkSession, root: str, subdir: str = "trades",
                 schema: T.StructType | str | None = None,
                 hours: list[tuple[str, str]] | None = None) -> DataFrame:
    """Read the un-keyed directory layout; path segments become columns.

    ``hours``, (date, HH) pairs, limits the listing to those directories of
    every pair (a glob per date), so that a range read opens no other file.

    ``location`` is the file path; ``pair``/``trade_date``/``hour`` come
    from its last three directories (typed DATE / TINYINT).

    Files written with per-flush inferred types can drift (e.g. integer
    prices); Parquet does not widen INT64 to DOUBLE on read.
    ``plain.read_drifted`` finds the kinds of files itself; ``schema`` reads
    one known kind: columns are cast to the trade_v1 types afterwards.
    """
    base = f"{root.rstrip('/')}/{subdir}"
    reader = spark.read.schema(schema or TRADE_V1).option("recursiveFileLookup", "true")
    if hours is None:
        df = reader.parquet(base)
    else:
        by_date: dict[str, list[str]] = {}
        for d, h in hours:
            by_date.setdefault(d, []).append(h)
        globs = [g for d, hs in by_date.items() if matches(spark, g := f"{base}/*/{d}/{{{','.join(hs)}}}")]
        if not globs:  # nothing landed in the range
            return read_unkeyed(spark, root, subdir, schema).where(F.lit(False))
        df = reader.parquet(*globs)
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRADE_V1.fields], "_metadata")
    return unkeyed_columns(df)


def unkeyed_columns(df: DataFrame) -> DataFrame:
    """trade_v1 columns plus location, pair, trade_date and hour from the file path."""
    path = F.col("_metadata.file_path")
    return df.select(
        *TRADE_V1_REQUIRED,
        path.alias("location"),
        F.regexp_extract(path, _UNKEYED, 1).alias("pair"),
        F.regexp_extract(path, _UNKEYED, 2).cast("date").alias("trade_date"),
        F.regexp_extract(path, _UNKEYED, 3).cast("tinyint").alias("hour"),
    )


def partition_dir(root: str, subdir: str, pair: str, trade_date: str, hour: str) -> str:
    """Un-keyed directory of one (pair, date, hour): ``root/subdir/pair/date/HH``."""
    return f"{root.rstrip('/')}/{subdir}/{pair}/{trade_date}/{hour}"


def matches(spark: SparkSession, glob: str) -> bool:
    """Whether any path matches ``glob`` (a listing on the driver, no job)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def refresh_external_table(spark: SparkSession, name: str) -> None:
    """Take up the lake's new, changed and removed directories."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def create_external_table(spark: SparkSession, root: str, db: str = "ext", name: str = "trades") -> str:
    """(Re)create ``db.name`` over the keyed lake and discover its partitions.

    Idempotent: drops the table definition (never the data) first. A
    missing database is created under ``root/_catalog`` (shared storage),
    never under a machine-local warehouse folder.
    """
    from ticklake.sources.catalog import ensure_namespaces

    if not spark.catalog.databaseExists(db):
        ensure_namespaces(spark, [db], location_root=f"{root.rstrip('/')}/_catalog")
    spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TRADE_V1.fields)
    parts = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LAKE_PARTITIONS.fields)
    spark.sql(
        f"CREATE TABLE `{db}`.`{name}` ({cols}, {parts}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(LAKE_PARTITION_COLS)}) LOCATION '{root}'"
    )
    spark.sql(f"MSCK REPAIR TABLE `{db}`.`{name}`")
    return f"{db}.{name}"
