"""Readers and writers for the event tables (SRC-*).

Every load is one schema-typed scan (never row-by-row inserts) and every
write is a partitioned parquet write, so both scale with the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import bounded_broadcast

# Raw payloads as a collector ships them: properties is a JSON object.
RAW_JSON_SCHEMA = ("event_id string, event_name string, event_category string, tenant_id string, "
                   "user_id string, session_id string, event_timestamp timestamp_ntz, "
                   "collector_tstamp timestamp_ntz, platform_version string, event_source string, "
                   "properties map<string,string>, sdk_version string")


ROWS_PER_CSV = 1_000_000


def read_raw_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2/SRC-3: load JSON-lines payloads with an explicit schema; the
    properties object is stored as its JSON text (``to_json``), as the raw
    table keeps it."""
    df = spark.read.schema(RAW_JSON_SCHEMA).option("mode", "PERMISSIVE").json(path)
    return df.withColumn("properties", F.to_json("properties"))


def write_raw_json(raw: DataFrame, path: str) -> None:
    """The inverse of ``read_raw_json`` (properties parsed back to an object)."""
    (raw.withColumn("properties", F.from_json("properties", "map<string,string>"))
        .write.mode("overwrite").json(path))


def write_region_local(events: DataFrame, dim_tenants: DataFrame, path: str) -> None:
    """SRC-8: land events partitioned by the tenant's home region (the
    tenant dimension is size-checked before it is broadcast)."""
    t = bounded_broadcast(dim_tenants.where(F.col("is_current")).select("tenant_id", "region"))
    from ..operators.model import clustered_layout
    landed = events.join(t, "tenant_id", "left").fillna({"region": "unassigned"})
    (clustered_layout(landed, "region", ["tenant_id", "event_timestamp"])
        .write.mode("overwrite").partitionBy("region").parquet(path))


def write_report_sets(sets: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """SRC-6: write each report data set under ``path/<name>`` (parquet or
    CSV with header); these replace the workbook sheets. Each set keeps its
    own partitioning (no single-task coalesce)."""
    for name, df in sets.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(f"{path}/{name}")
        else:
            w.parquet(f"{path}/{name}")


def write_named_csv(df: DataFrame, path: str, name_col: str, rows_per_file: int = ROWS_PER_CSV) -> None:
    """One CSV file per value of ``name_col``, named ``<value>.csv``; a value of more than ``rows_per_file`` rows
    has its further parts in ``<name_col>=<value>/<part>.csv``, so that no task holds a whole value. Values are
    file names, so there are few; the rows are written by tasks and only the finished files are renamed."""
    spark = df.sparkSession
    parts = df.groupBy(name_col).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_parts")).where("_parts > 1")
    parts = F.broadcast(parts.withColumnRenamed(name_col, "_value"))
    dealt = (df.join(parts, df[name_col].eqNullSafe(F.col("_value")), "left")
             .withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.coalesce("_parts", F.lit(1)))))
    (dealt.repartition(name_col, "_part").select(*df.columns).write.partitionBy(name_col).option("maxRecordsPerFile", rows_per_file)
          .option("header", True).csv(f"{path}/_parts"))
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/_parts")):
        name = folder.getPath().getName()
        key, _, value = name.partition("=")
        if key != name_col:
            continue
        # readers skip files named _ or . first (such as the null value's): its parts stay with it
        more = value if value.startswith(("_", ".")) else name
        parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        for k, part in enumerate(parts):
            to = jvm.org.apache.hadoop.fs.Path(f"{path}/{value}.csv" if not k else f"{path}/{more}/{k}.csv")
            if k:
                fs.mkdirs(to.getParent())
            fs.rename(part, to)
