"""Session construction and the checkpoint folder used by iterative jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from measured shuffle
# sizes (runtime broadcast only when the built side is measured small), splits
# skewed partitions, and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskgraph", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster the master and most sizing come from spark-submit; only the
    keys above are forced. ``shuffle_partitions`` should be sized so one
    shuffle partition stays around 128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is read and used as is. Only when it is unset (local tests) a fresh
    scratch folder is made.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a local context
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    if sc is not None and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc is None:
        raise ValueError("set spark.checkpoint.dir: a session without a local context cannot tell a shared folder")
    local = tempfile.mkdtemp(prefix="riskgraph-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package from where the
    driver has it. On a cluster it is shipped with --py-files."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))


# tables that were written for the result in hand (see ``written``): path and frame
_PASSING: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("passing", default=None)
# a write's shuffle files go with its end, not when the driver's JVM next collects garbage
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _conf(spark: SparkSession, **mine: str) -> Iterator[None]:
    """Settings by key; put back at the end."""
    before = {k: spark.conf.get(k, None) for k in mine}
    try:
        for k, v in mine.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the reliable checkpoint
    folder and continue from that table.

    Used by the iterative algorithms once per round: a lost executor then
    re-reads the table instead of replaying every earlier round. A written
    table is preferred over ``Dataset.checkpoint()`` because a checkpoint
    keeps the size estimate of the plan it replaced; in a loop that joins a
    frame with something derived from itself the estimate squares every
    round (and eventually exhausts the driver), while a read-back table
    carries its true file size, which is also what AQE and the broadcast
    threshold should see.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"tables/{uuid.uuid4().hex}")
    with _conf(spark, **{_SHUFFLES_GO: "true"}):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    if (passing := _PASSING.get()) is not None:
        passing.append((path, out))
    return out


def written(spark: SparkSession, build: Callable[[], DataFrame | tuple]) -> DataFrame | tuple:
    """``cut_lineage`` of the frame that ``build`` returns, or of each of them. The other
    tables that ``cut_lineage`` wrote in ``build`` are deleted then, so what is to be read
    later is asked for before. Calls may be nested: the results are then tables of the outer
    one. A frame that is such a table already is not written again."""
    mine: list[tuple[str, DataFrame]] = []
    outer = _PASSING.get()
    token = _PASSING.set(mine)
    try:
        got = build()
        some = got if isinstance(got, tuple) else (got,)
        out = tuple(df if any(df is t for _, t in mine) else cut_lineage(df) for df in some)
    finally:
        _PASSING.reset(token)
    for path, table in mine:
        if not any(table is df for df in out):
            _delete(spark, path)
        elif outer is not None:
            outer.append((path, table))
    return out if isinstance(got, tuple) else out[0]


@contextmanager
def staying() -> Iterator[None]:
    """For tables that others read too: they stay, whoever asks for them first."""
    token = _PASSING.set(None)
    try:
        yield
    finally:
        _PASSING.reset(token)


def kept(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """``written`` for such a table."""
    with staying():
        return written(spark, build)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def cut_lineage_observed(df: DataFrame, bucket_by: list[str] | None = None, buckets: int | None = None,
                         **metrics) -> tuple[DataFrame, dict]:
    """``cut_lineage`` (or ``bucketed_table`` when ``bucket_by`` is given)
    that also returns aggregate metrics (``name=Column`` aggregates) of the
    written rows, computed over the written table: one scalar row to the
    driver. (``DataFrame.observe`` would save that scan, but in Spark 4.1
    an observation registered on the session makes later pyspark.ml model
    transforms fail to serialise, so it is not used.)"""
    if bucket_by:
        out = bucketed_table(df, bucket_by, buckets or shuffle_partitions(df.sparkSession))
    else:
        out = cut_lineage(df)
    row = out.agg(*[c.alias(n) for n, c in metrics.items()]).first()
    return out, row.asDict()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def fixed_shuffles(spark: SparkSession, partitions: int) -> Iterator[None]:
    """For plans of many short rounds over a bucketed table: the number of shuffle
    partitions follows the job's measured rows, and a plan is not planned anew after each
    of its stages (bucketed joins leave AQE nothing to change). Put back at the end."""
    with _conf(spark, **{"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": "false"}):
        yield


def bucketed_table(df: DataFrame, cols: list[str], buckets: int) -> DataFrame:
    """Write ``df`` once as a table bucketed on ``cols`` in the
    checkpoint folder. Joins on ``cols`` against it then shuffle only the
    other side, which is what an iterative job over a fixed edge table
    wants every round."""
    spark = df.sparkSession
    name = f"rg_{uuid.uuid4().hex}"
    path = scratch_dir(spark, f"tables/{name}")
    # dealt by the bucket columns first, so each bucket is one file
    (df.repartition(buckets, *cols).write.mode("overwrite").bucketBy(buckets, *cols)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, beside the checkpoints."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
