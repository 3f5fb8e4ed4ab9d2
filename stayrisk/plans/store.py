"""Write-once result tables in the session's shared checkpoint folder.

Expensive results (the derived bookings, out-of-fold scores, ablation table)
are computed once, written as parquet under ``spark.checkpoint.dir`` and read
back by every later query: lineage is cut and a lost executor only replays
the read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return p.getFileSystem(conf).exists(p)


def identity(spark: SparkSession, folder: str) -> str:
    """Path, size and modification time of every file under ``folder``: changed inputs get new stored tables."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()


def path_for(spark: SparkSession, kind: str, key: str, inputs: str | None = None) -> str:
    """Where the table ``key`` of this kind is stored; ``inputs`` is the folder it is derived from."""
    if inputs is not None:
        key = f"{key}:{identity(spark, inputs)}"
    tag = hashlib.sha1(key.encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stayrisk-{kind}/{tag}"


def stored(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; if there is none, it is written beside it first and renamed, so a reader never sees half."""
    if not exists(spark, path):
        part = f"{path}.{uuid.uuid4().hex}"
        build().write.parquet(part)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        target = hadoop(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(hadoop(part), target)
    return spark.read.parquet(path)


def written(spark: SparkSession, kind: str, key: str, build: Callable[[], DataFrame], inputs: str | None = None) -> DataFrame:
    """Return the table stored under (kind, key, state of the input files), building and writing it on first use."""
    return stored(spark, path_for(spark, kind, key, inputs), build)
