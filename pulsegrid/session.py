"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_GROUP_ROWS = 2_000_000
DEFAULT_RANKED_ROWS = 1_000_000
DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def build_session(app: str = "pulsegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator here expects."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master, whose one process sees its own disk, gets a temporary folder where
    neither the session nor the context names one; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="pulsegrid-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; it belongs to the innermost open ``scratch_scope``."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables that were written inside.

    A frame made inside reads these tables, so write the result before the scope ends::

        with scratch_scope(spark):
            near_duplicates(docs).write.parquet(target)
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in made:
            where = hadoop.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: rows are written once, so later passes see the same rows."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write large rows once as Parquet in the shared folder and read them back.

    Like ``materialise``, but later passes prune columns and push filters down.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_row_limit(spark: SparkSession) -> int:
    """Most rows of one group that a single task may sort."""
    return int(spark.conf.get("spark.pulsegrid.maxGroupRows", str(DEFAULT_GROUP_ROWS)))


def ranked_row_limit(spark: SparkSession) -> int:
    """Most rows of a group whose values are ranked by a sort; larger groups are read by counting passes."""
    return int(spark.conf.get("spark.pulsegrid.maxRankedRows", str(DEFAULT_RANKED_ROWS)))


def broadcast_row_limit(spark: SparkSession) -> int:
    """Most rows a side may have to be broadcast."""
    return int(spark.conf.get("spark.pulsegrid.maxBroadcastRows", str(DEFAULT_BROADCAST_ROWS)))


def broadcast_byte_limit(spark: SparkSession) -> int:
    """Most bytes a side may have to be broadcast."""
    return int(spark.conf.get("spark.pulsegrid.maxBroadcastBytes", str(DEFAULT_BROADCAST_BYTES)))


def named(rows: DataFrame, column: str, most: int = 20) -> str:
    """For messages: the first values of a column in order and how many there are in all ("" for none)."""
    total = rows.count()
    if not total:
        return ""
    first = [str(r[0]) for r in rows.select(column).orderBy(column).limit(most).collect()]
    return ", ".join(first) + (f" and {total - most} more ({total} in all)" if total > most else "")
