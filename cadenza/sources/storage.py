"""Folders of any file system Spark has a path for: listings, copies, and data sets kept as folders of splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def listing(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (), recursive: bool = True) -> DataFrame:
    """``(path, length, modified)`` of the files below a folder whose names end with one of the suffixes, or all; contents aren't
    read, and pages of a listing are followed to the end."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    wanted = F.lit(not suffixes)
    for s in suffixes:
        wanted = wanted | F.col("path").endswith(s)
    return files.filter(wanted).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below one, sorted."""
    fs, at = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory())


def copy_folder(spark: SparkSession, source: str, target: str) -> int:
    """Copies a folder's files to another, on whatever file systems, hidden ones left out; the number copied. From the driver, for
    folders of results."""
    here, at = _fs(spark, source)
    there, to = _fs(spark, target)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    there.mkdirs(to)
    n = 0
    for f in here.listStatus(at):
        name = f.getPath().getName()
        if name.startswith((".", "_")):
            continue
        child = jvm.org.apache.hadoop.fs.Path(to, name)
        if f.isDirectory():
            n += copy_folder(spark, f.getPath().toString(), child.toString())
        else:
            n += bool(jvm.org.apache.hadoop.fs.FileUtil.copy(here, f.getPath(), there, child, False, True, conf))
    return n


def write_dataset(df: DataFrame, root: str, name: str, split: str, config: str = "default", rows_per_file: int = 1_000_000) -> str:
    """A split of a data set as a folder of Parquet files; its path."""
    path = f"{root}/{name}/{config}/{split}"
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def read_dataset(spark: SparkSession, root: str, name: str, split: str | None = None, config: str = "default") -> DataFrame:
    """A split of a data set kept by :func:`write_dataset`, or all of them with the column ``split``."""
    if split:
        return spark.read.parquet(f"{root}/{name}/{config}/{split}")
    found = None
    for s in subfolders(spark, f"{root}/{name}/{config}"):
        part = spark.read.parquet(f"{root}/{name}/{config}/{s}").withColumn("split", F.lit(s))
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"no split of {name} in {root}")
    return found
