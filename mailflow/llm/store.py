"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from mailflow.session import work_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


BLOCKS: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored in the block are removed at its end, but those that stay: these, and
    what is read from them alone, may be used after it.  Blocks may be nested."""
    made: list[str] = []
    token = BLOCKS.set((*BLOCKS.get(), made))
    try:
        yield
    finally:
        BLOCKS.reset(token)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, records: int | None = None, stays: int = 0) -> DataFrame:
    """Write a table once and read it back: the lineage ends here, a lost executor
    costs nothing, and Spark knows the table's size when it plans later joins.  Shuffle
    files of the write go with its end, as nothing asks for them again.  ``records``: rows that go to Python at once.  ``stays``: how many of the
    innermost blocks of ``passing`` the table outlives, up to the end of the one around them."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    blocks = BLOCKS.get()[: max(0, len(BLOCKS.get()) - stays)]
    if blocks:
        blocks[-1].append(path)
    wanted = {CLEANUP: "true"} | ({BATCH: str(records)} if records else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
