"""G-9: erasing tenants from a stored, date-partitioned table, and the deadlines of their requests.

Only the files that hold an erased tenant are rewritten. A manifest (which
file holds which tenant) finds them; their other rows are written to a
staging folder, and once that is complete the old files are deleted and the
new ones moved in. A run that broke off in between is finished by calling it
again with its ``run_id``: the staged rows and the list of old files are
still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import bounded_broadcast


def file_manifest(spark: SparkSession, path: str, key: str = "tenant_id") -> DataFrame:
    """(file, key, rows) of a stored table; reads one column."""
    return (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), key)
                 .groupBy("file", key).agg(F.count(F.lit(1)).alias("rows")))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    return jvm, jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def erase_tenant_files(spark: SparkSession, path: str, tenants: DataFrame, partition_col: str, run_id: str,
                       key: str = "tenant_id") -> list[str]:
    """Remove the tenants' rows; returns the files that were replaced. All other files keep their names.

    The list of files is collected: one entry per rewritten file, no rows.
    """
    stage = f"{path}/_erasure-{run_id}"
    jvm, fs = _fs(spark, path)
    hpath = jvm.org.apache.hadoop.fs.Path
    ids = bounded_broadcast(tenants.select(key).distinct())
    if not fs.exists(hpath(f"{stage}/old/_SUCCESS")):
        old = [r.file for r in file_manifest(spark, path, key).join(ids, key, "left_semi").select("file").distinct().collect()]
        if not old:
            return []
        (spark.read.option("basePath", path).parquet(*old).join(ids, key, "left_anti")
              .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(f"{stage}/data"))
        # written last: from here on the run can be finished, before it is as if it never was
        spark.createDataFrame([(f,) for f in old], "file string").coalesce(1).write.mode("overwrite").parquet(f"{stage}/old")
    old = [r.file for r in spark.read.parquet(f"{stage}/old").collect()]
    for f in old:
        fs.delete(hpath(jvm.java.net.URI(f)), False)
    for folder in fs.listStatus(hpath(f"{stage}/data")):
        name = folder.getPath().getName()
        if "=" in name:
            for part in fs.listStatus(folder.getPath()):
                fs.rename(part.getPath(), hpath(f"{path}/{name}/{run_id}-{part.getPath().getName()}"))
    return old


def erasure_ledger(requests: DataFrame, manifest: DataFrame, as_of: str, days: int = 30, key: str = "tenant_id") -> DataFrame:
    """Every request (``key``, ``requested_on``) with its deadline, the rows still held and its status:
    DONE, OPEN, or OVERDUE when rows are left after the deadline."""
    left = manifest.groupBy(key).agg(F.sum("rows").alias("rows_left"))
    r = requests.join(left, key, "left").withColumn("rows_left", F.coalesce("rows_left", F.lit(0).cast("long")))
    r = r.withColumn("deadline", F.date_add("requested_on", days))
    return r.select(key, "requested_on", "deadline", "rows_left",
                    F.when(F.col("rows_left") == 0, "DONE").when(F.lit(as_of).cast("date") > F.col("deadline"), "OVERDUE").otherwise("OPEN").alias("status"))
