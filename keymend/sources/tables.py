"""Tables by path or name, durable intermediates and global numbering."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A legacy table over JDBC, read in `parts` ranges of a numeric key."""
    return (spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=key, lowerBound=str(low),
                                              upperBound=str(high), numPartitions=str(parts), **options).load())


def save(df: DataFrame, name: str, properties: dict[str, str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Write a managed table and its provenance, and read it back. Parquet stands in where the session has
    no other default format."""
    spark = df.sparkSession
    df.write.mode(mode).saveAsTable(name)
    if properties:
        listed = ", ".join("'" + k.replace("'", "\\'") + "' = '" + v.replace("'", "\\'") + "'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    return spark.table(name)


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def drop_all(spark: SparkSession, schema: str) -> int:
    """Drop every table of a schema; returns how many."""
    names = [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{n}")
    return len(names)


def resolve_fact(spark: SparkSession, name: str, use_fixed: bool) -> str:
    """The rebuilt copy of a fact where there is one and it is asked for."""
    fixed = f"{name}_fixed"
    return fixed if use_fixed and exists(spark, fixed) else name


_RUN = uuid.uuid4().hex
_FOLDERS: set[str] = set()


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may be gone at exit; the folder then stays for the cluster's own cleaner
        pass


def frozen(df: DataFrame) -> DataFrame:
    """A durable copy in the shared folder that `spark.checkpoint.dir` names (one in the warehouse where unset).
    Removed when the driver's process ends."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    folder = f"{base.rstrip('/')}/keymend-tables-{_RUN}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        atexit.register(_remove, spark, folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Adds 1, 2, ... in a global order without gathering all rows in one task: rows are range
    partitioned and frozen, numbered within each range, and shifted by the rows of the ranges before."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = frozen(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    shifts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))  # one row per range
    inside = Window.partitionBy("__part").orderBy(*order)
    out = ranged.withColumn("__row", F.row_number().over(inside)).join(F.broadcast(shifts), "__part")
    return out.withColumn(name, (F.col("__shift") + F.col("__row")).cast("long")).drop("__part", "__row", "__shift")
