"""Session helpers: settings the operators rely on, and shared work folders."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings to use when a session is built for this package.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Recording a call site per expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "mailflow", **settings) -> SparkSession:
    """Start (or get) a session with the package's settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Make a session ready for the operators.

    Zone-less mail times are UTC wall clock, so the session must be UTC.  The
    package is sent to the Python workers once, as ``--py-files`` would do.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    context = spark.sparkContext
    if spark.conf.get("mailflow.shipped", None) != context.applicationId:
        package = Path(__file__).resolve().parent
        archive = f"{tempfile.mkdtemp(prefix='mailflow-package-')}/mailflow"
        context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
        spark.conf.set("mailflow.shipped", context.applicationId)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and intermediate tables.

    Where none is configured a temporary folder is taken and remembered for the
    session, but only in local mode: other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("mailflow.work.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="mailflow-")
        spark.conf.set("mailflow.work.dir", root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root; nothing else writes to it."""
    return f"{shared_root(spark)}/mailflow/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once and read it back: its lineage ends here, and a
    lost executor costs nothing that was written."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold in the block only."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a table that arrives in fewer splits than there are cores one
    hash partition per core; leave a table with enough splits as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
