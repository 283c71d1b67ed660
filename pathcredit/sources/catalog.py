"""Sources and sinks by table name: what a session's catalog knows, beside Parquet folders."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import new_state_dir

#: A table's name: one to three plain or quoted parts. Anything else is a path.
NAME = re.compile(r"(?:[A-Za-z_]\w*|`[^`]+`)(?:\.(?:[A-Za-z_]\w*|`[^`]+`)){0,2}")


def is_name(told: str) -> bool:
    return NAME.fullmatch(told) is not None


def read_source(spark: SparkSession, told: str) -> DataFrame:
    """A table of the session's catalog by its name, or the Parquet folder at a path (``./x`` where it is one word)."""
    return spark.table(told) if is_name(told) else spark.read.parquet(told)


def write_sink(df: DataFrame, told: str, partition_by: str | None = None, using: str = "parquet") -> None:
    """Replace a table of the session's catalog, or the Parquet folder at a path, by ``df``.

    A new table is created in the format ``using``; an existing one keeps its format. Where the catalog can
    replace a table at once (lakehouse formats) it does; the session's own catalog overwrites the table's files."""
    spark = df.sparkSession
    if not is_name(told):
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(told)
    elif not spark.catalog.tableExists(told):
        writer = df.writeTo(told).using(using)
        (writer.partitionedBy(F.col(partition_by)) if partition_by else writer).create()
    elif spark.sql(f"DESCRIBE TABLE EXTENDED {told}").filter("col_name = 'Provider' and lower(data_type) in ('delta', 'iceberg')").isEmpty():
        writer = df.write.mode("overwrite").format(using)
        (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(told)
    else:
        df.writeTo(told).createOrReplace()


def bucketed(df: DataFrame, key: str, label: str, what: str | None = None, path: str | None = None) -> tuple[DataFrame, str]:
    """``df`` stored by buckets of ``key``, as many as the session's shuffles have partitions: joins on the key read
    it without shuffling it again. Returns it and the table's name, for ``forget``. Rows without the key, which no
    join finds, are left out. With ``what`` a key that occurs twice is an error, counted as the buckets are written."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{re.sub(r'[^A-Za-z0-9_]', '_', label)}_{uuid.uuid4().hex[:12]}"
    rows, seen = df.filter(F.col(key).isNotNull()), Observation()
    if what:
        rest = [c for c in df.columns if c != key]
        rows = (rows.groupBy(key).agg(*[F.first(c).alias(c) for c in rest], F.count("*").alias("_times"))
                .observe(seen, F.max("_times").alias("most")).drop("_times").select(*df.columns))
    (rows.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
     .option("path", path or new_state_dir(spark, label)).saveAsTable(name))
    if what and (seen.get["most"] or 0) > 1:
        forget(spark, name)
        raise ValueError(f"{what}: {key} must be unique")
    return spark.table(name), name


def forget(spark: SparkSession, name: str) -> None:
    """Take a stored table out of the catalog; its files stay for readers that hold it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
