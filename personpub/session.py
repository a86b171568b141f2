"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # a JSON object may repeat a name; the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(
    app: str = "personpub", master: str | None = None, **conf: object
) -> SparkSession:
    """A session with the settings above; `conf` takes keys with `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as `spark.checkpoint.dir` names it.

    Only a local session, where driver and executors are one process, gets a
    folder of its own when none is set.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="personpub-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/personpub/{name}-{uuid.uuid4().hex}"


_kept: dict[tuple[str, str], object] = {}


def kept[T](spark: SparkSession, name: str, build: Callable[[str], T]) -> T:
    """What `build` made of a new folder for this application, once per name.

    For indexes that are written by a step of their own and read by many queries.
    """
    key = (spark.sparkContext.applicationId, name)
    if key not in _kept:
        _kept[key] = build(scratch(spark, "kept"))
    return _kept[key]


def is_missing(error: AnalysisException) -> bool:
    """Whether a read failed because nothing has been written there yet."""
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def settle(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder, so that later uses see one result.

    The table outlives a lost executor, is read by column, and its size is
    known to the planner. Let the folder's own clean-up remove old ones.
    """
    path = scratch(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
