"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan in this package relies on. A shuffle begins with many partitions, which
# adaptive execution joins up to a fixed size, so what a task holds does not grow with the input. A sort
# and two aggregates over a partition take some forty times its compressed size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


#: Joins of a warehouse build broadcast what was hinted, or measured to be small while the plan runs.
MEASURED_JOINS = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m"}


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Inside, no join is broadcast because of the size of its files.

    Written ids pack thirty-fold, so millions of rows would look small and be held by the driver, several at a time.
    Plans made meanwhile by other threads of the session follow the same rule.
    """
    before = {key: spark.conf.get(key, None) for key in MEASURED_JOINS}
    try:
        for key, value in MEASURED_JOINS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build_session(app: str = "starloom", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own to :func:`tune`."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "8g",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-"))
    return context.getCheckpointDir()


#: Scratch paths given out, by application.
_given: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch paths given out in this application and not deleted."""
    return list(_given.get(spark.sparkContext.applicationId, ()))


def delete_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables; for callers that do not read them any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kept = _given.setdefault(spark.sparkContext.applicationId, [])
    for path in list(paths):
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
        if path in kept:
            kept.remove(path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts the lineage, so a lost executor re-reads files instead of recomputing, and gives
    later passes columnar pruning that a cached RDD would not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
