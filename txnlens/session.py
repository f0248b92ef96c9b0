"""Session helpers: a sensible builder and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(app_name: str = "txnlens", *, master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC, ANSI casts and adaptive execution (skew splitting on)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see, as the cluster names it.

    Only a local master may fall back to a temporary folder of the machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="txnlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_HANDED_OUT: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/txnlens/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was written under :func:`scratch_path` meanwhile; results must be written elsewhere by then."""
    before = len(_HANDED_OUT)
    try:
        yield
    finally:
        context = spark.sparkContext
        for name in _HANDED_OUT[before:]:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        del _HANDED_OUT[before:]


def materialize(df: DataFrame, label: str = "step", *, partition_by: Sequence[str] = (),
                read_as: T.StructType | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back, with another schema of equal layout if wanted.

    The files outlive the executors that wrote them, unlike cached blocks.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(read_as or df.schema).parquet(path)
