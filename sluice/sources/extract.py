"""Source reads, full and incremental extract, landing reads.

Every reader returns a lazy DataFrame; the incremental predicate is a
Column comparison, so Catalyst pushes it to the Parquet scan
(``PushedFilters``) or into the JDBC query's WHERE clause.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.functions.scalar import dated_path, fmt_ts, FILE_DAY_FORMAT
from sluice.spec import schema_of

# Fixed value: the reference's default watermark for a table never loaded.
DEFAULT_TIMESTAMP_WATERMARK = "1900-01-01 00:00:00"
INTEGER_TYPES = ("INT", "INTEGER", "BIGINT", "LONG", "SMALLINT", "NUMBER")


def default_watermark(cdc_column_type: str | None) -> str:
    """Watermark of a first run: the earliest value of the column's type."""
    t = (cdc_column_type or "TIMESTAMP").upper()
    if t in INTEGER_TYPES:
        return str(-(2 ** 63))
    if t == "DATE":
        return "1900-01-01"
    return DEFAULT_TIMESTAMP_WATERMARK


def typed_watermark(value, data_type: T.DataType) -> Column:
    """A watermark literal in the CDC column's own type (never a string compare)."""
    if isinstance(value, Column):
        return value.cast(data_type)
    if isinstance(value, (dt.datetime, dt.date, int, float)):
        return F.lit(value).cast(data_type)
    return F.lit(str(value)).cast(data_type)


def extract(df: DataFrame, load_type: str = "FULL", cdc_column: str | None = None,
            watermark=None, lookback: dt.timedelta | int | None = None,
            cdc_column_type: str | None = None) -> DataFrame:
    """Whole table for FULL, else rows at or after the watermark.

    CDC and INCREMENTAL behave alike (``>=``: a row stamped exactly at the
    watermark is read again; the merge absorbs the repeat).  ``lookback``
    widens the window (an interval for time columns, a count for integer
    columns) so late-arriving rows are picked up again.
    """
    if (load_type or "FULL").upper() == "FULL":
        return df
    if not cdc_column:
        raise ValueError(f"load_type {load_type} needs a cdc_column")
    dtype = df.schema[cdc_column].dataType
    value = F.col(cdc_column)
    if isinstance(dtype, T.StringType) and cdc_column_type:   # text sources (CSV)
        dtype = {"BIGINT": T.LongType(), "INT": T.LongType(), "DATE": T.DateType()}.get(
            cdc_column_type.upper(), T.TimestampNTZType())
        value = value.try_cast(dtype)
    if watermark is None:
        watermark = default_watermark(cdc_column_type or _type_name(dtype))
    wm = typed_watermark(watermark, dtype)
    if lookback:
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            secs = lookback.total_seconds() if isinstance(lookback, dt.timedelta) else lookback
            wm = (wm.cast(T.TimestampNTZType())
                  - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs))).cast(dtype)
        else:
            wm = wm - F.lit(int(lookback))
    return df.where(value >= wm)


def _type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType)):
        return "BIGINT"
    if isinstance(dtype, T.DateType):
        return "DATE"
    return "TIMESTAMP"


def with_source_file(df: DataFrame) -> DataFrame:
    """File lineage of every row from the file source's ``_metadata``."""
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, corrupt_column: str | None = "_corrupt") -> DataFrame:
    """CSV with an explicit schema; malformed lines kept in ``_corrupt``."""
    s = schema_of(schema) if isinstance(schema, str) else schema
    r = spark.read.option("header", str(header).lower()).option("mode", "PERMISSIVE")
    if corrupt_column:
        s = T.StructType(list(s.fields) + [T.StructField(corrupt_column, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.schema(s).csv(path)


def jdbc_reader(spark: SparkSession, url: str, *, table: str | None = None,
                query: str | None = None, properties: Mapping[str, str] | None = None,
                partition_column: str | None = None, lower_bound=None, upper_bound=None,
                num_partitions: int | None = None, fetch_size: int | None = None) -> DataFrame:
    """Relational source through JDBC.

    Unpartitioned by default (one connection); with ``partition_column``
    and bounds the read is split into ``num_partitions`` range queries.
    ``fetch_size`` is the config's ``batch_size``.  ``query`` replaces the
    table with a custom source query.
    """
    r = spark.read.format("jdbc").option("url", url)
    if query:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column)
              .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
              .option("numPartitions", str(num_partitions or 8)))
    if fetch_size:
        r = r.option("fetchsize", str(fetch_size))
    return r.load()


def _source_path(cfg: Mapping) -> str:
    parts = [cfg.get(k) for k in ("source_server", "source_database", "source_schema")]
    parts = [str(p).rstrip("/") for p in parts if p]
    return "/".join(parts + [str(cfg["source_table"])])


def read_source(spark: SparkSession, cfg: Mapping, csv_schema=None,
                jdbc_properties: Mapping[str, str] | None = None,
                jdbc_partition: Mapping | None = None) -> DataFrame:
    """Read a configured source by ``source_type``.

    ``jdbc_partition`` (``partition_column``, ``lower_bound``, ``upper_bound``,
    ``num_partitions``) splits a JDBC read where the row says ``parallel_copy``.
    A CSV source without ``csv_schema`` is read as text under its header's names
    (only the header is read for that); the typed load casts it.

    PARQUET / CSV / API (landed JSON pages): files under
    ``source_server/source_database/source_schema/source_table``; ``csv_schema``
    is the explicit schema for CSV and JSON.
    SQLSERVER: JDBC (``source_server`` is the URL).  A ``source_query`` replaces
    the table: run through JDBC, or as Spark SQL over registered views.
    """
    stype = (cfg.get("source_type") or "PARQUET").upper()
    query = cfg.get("source_query")
    if stype == "SQLSERVER":
        return jdbc_reader(spark, cfg["source_server"],
                           table=None if query else
                           ".".join(p for p in (cfg.get("source_schema"), cfg["source_table"]) if p),
                           query=query, properties=jdbc_properties,
                           fetch_size=cfg.get("batch_size"),
                           **(jdbc_partition if jdbc_partition and cfg.get("parallel_copy") else {}))
    if query:
        return spark.sql(query)
    path = _source_path(cfg)
    if stype == "PARQUET":
        return spark.read.parquet(path)
    if stype == "CSV":
        if csv_schema is None:
            return spark.read.option("header", "true").option("mode", "PERMISSIVE").csv(path)
        return read_csv(spark, path, csv_schema)
    if stype == "API":
        # API pages are landed as JSON files by the caller; they are read as files
        # (an explicit schema avoids an inference pass over the pages)
        r = spark.read.option("mode", "PERMISSIVE")
        return (r.schema(csv_schema) if csv_schema is not None else r).json(path)
    raise ValueError(f"source_type {stype} is not a readable source type")


def landing_path(root: str, container: str | None, folder: str, table: str,
                 now: dt.datetime) -> str:
    """K1 path: ``<root>/<container>/<folder>/yyyy/MM/dd/<table>_yyyyMMdd.parquet``.

    Exactly one ``/`` between folder and date (the reference glues them).
    """
    parts = [root.rstrip("/")]
    if container:
        parts.append(container.strip("/"))
    if folder:
        parts.append(folder.strip("/"))
    parts.append(dated_path(now))
    parts.append(f"{table.lower()}_{fmt_ts(now, FILE_DAY_FORMAT)}.parquet")
    return "/".join(parts)


def read_landing(spark: SparkSession, path: str, batch_id: str | None = None,
                 lower_case: bool = True) -> DataFrame:
    """Read landed Parquet back, with file lineage, names lower-cased.

    The landing folder holds ``_landing_batch=`` subfolders; naming one prunes the
    scan to that batch's files.
    """
    r = spark.read.option("basePath", path)
    df = r.parquet(f"{path}/_landing_batch={batch_id}" if batch_id else path)
    df = with_source_file(df)
    if lower_case:
        df = df.toDF(*[c.lower() for c in df.columns])
    if "_landing_batch" in df.columns:
        df = df.drop("_landing_batch")
    return df


def replay(spark: SparkSession, root: str, container: str | None, folder: str, table: str,
           day: dt.datetime, batch_id: str | None = None) -> DataFrame:
    """Re-read an older landing without extracting again."""
    return read_landing(spark, landing_path(root, container, folder, table, day), batch_id)
