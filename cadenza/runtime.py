"""Session helpers: shared folder, lineage cuts, sizes read from the session."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where the session names none, a temporary one is set if everything runs in this process (tests, laptops); on a
    cluster that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not re.match(r"local(\[.*\])?$", sc.master):
            raise RuntimeError("on a cluster spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cadenza-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back: computed once, lineage cut,
    readable after the loss of any executor. The table goes when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python functions are found wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cadenza-")) / "cadenza.zip"  # read by the driver alone, whose file server hands it out
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    sc.addPyFile(str(target))
    _shipped.add(sc.applicationId)


class Shared:
    """A broadcast, with an id for what Python workers make of it and keep."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast, self.id = spark.sparkContext.broadcast(value), uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


_kept: dict[tuple, object] = {}


def once(name: tuple, make: Callable):
    """What ``make`` gives, made once per Python worker and kept under ``name``; of old ones sixteen are kept."""
    if name not in _kept:
        while len(_kept) >= 16:
            del _kept[next(iter(_kept))]
        _kept[name] = make()
    return _kept[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
