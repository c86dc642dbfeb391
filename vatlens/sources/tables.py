"""Readers and writers. Nothing here collects data to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

TESTDATA_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One TESTDATA table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             sep: str = ",") -> DataFrame:
    """CSV with an explicit schema (never inferred: inference is a full extra scan)."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep)


def table_exists(spark: SparkSession, path_or_table: str) -> bool:
    """Source-exists probe for a catalog table or a folder of data files.

    A folder counts when it holds at least one visible entry (file or
    partition folder); the probe asks the Hadoop file system of the path, so it
    works the same for local, HDFS and object-store paths and never fails an
    analysis."""
    if "/" not in path_or_table:
        return spark.catalog.tableExists(path_or_table)
    try:
        jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    except AttributeError:                            # no JVM gateway (Spark Connect)
        try:
            spark.read.parquet(path_or_table).schema
            return True
        except AnalysisException:
            return False
    path = jvm.org.apache.hadoop.fs.Path(path_or_table)
    fs = path.getFileSystem(jsc.hadoopConfiguration())
    if not fs.exists(path):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(path))


def folder_state(spark: SparkSession, path: str) -> tuple:
    """(name, size, time of change) of each entry of a folder, asked of its own file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    entries = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in entries))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def dates_as_text(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if "timestamp" in t or "date" in t:
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)
