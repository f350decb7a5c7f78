"""Session construction, the shared scratch folder and lineage cuts.

Cluster jobs inherit their configuration from the submitting environment:
``get_session`` only fills in settings that are unset, and everything that has
to be written between two jobs goes below ``spark.checkpoint.dir``, the folder
that driver and executors share. Only a plain ``local[...]`` session, where
driver and executors are one process on one disk, may fall back to a temporary
folder; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions (one key may hold a third of the rows), and switch to broadcast
# only when the measured build side is small.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "riskframe") -> SparkSession:
    """A session with the defaults above. A running session or a setting made
    by the submitter keeps its value."""
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app)
        if master:
            builder = builder.master(master).config("spark.driver.memory", "16g")
        if shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        builder = (builder.config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
        active = builder.getOrCreate()
        active.sparkContext.setLogLevel("ERROR")
    given = dict(active.sparkContext.getConf().getAll())
    for key, value in SCALE_CONF.items():
        if key not in given:
            active.conf.set(key, value)
    return active


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder: the one in use, else the one the session names, else
    (local sessions only) a new temporary folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = sc.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        named = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for one intermediate table in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: the
    lineage ends there, and a lost executor costs no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of one task of an iterative fit: at least as many where rows are few, at most where they are many.
FEW_ROWS, MANY_ROWS = 4096, 250_000


def fit_parts(rows: int, slots: int) -> int:
    """Partitions of the training rows of an iterative fit. It runs hundreds of short
    jobs over them, whose time is mostly that of starting tasks, and a tree sends its
    statistics once per task: one task per slot, more only where a task had too many rows."""
    if rows < slots * FEW_ROWS:
        return max(1, math.ceil(rows / FEW_ROWS))
    return slots * math.ceil(rows / (slots * MANY_ROWS))


def dealt(df: DataFrame) -> DataFrame:
    """The rows of an iterative fit in ``fit_parts`` partitions, cached. ``df`` is read twice."""
    return df.repartition(fit_parts(df.count(), df.sparkSession.sparkContext.defaultParallelism)).cache()


def read_dealt(df: DataFrame) -> DataFrame:
    """Rows that lie in files, in ``fit_parts`` partitions at most, neither shuffled nor cached: a fit
    that keeps its own blocks of them in memory or on disk reads the files a few times only."""
    return df.coalesce(fit_parts(df.count(), df.sparkSession.sparkContext.defaultParallelism))


def one_per_slot(df: DataFrame) -> DataFrame:
    """The rows in no more partitions than there are slots, without a shuffle: a deep tree
    sends the statistics of all its open nodes once per task, however few rows that has."""
    return df.coalesce(df.sparkSession.sparkContext.defaultParallelism)


def side_by_side(fit, jobs: list, df: DataFrame, at_once: int | None = None, width: int = 20) -> list:
    """``[fit(job) for job in jobs]`` from a bounded driver thread pool, for independent fits
    on the rows of ``df``: as many in flight as there are slots where the rows are few
    (such fits wait for the driver), one by one where the copies that the fits keep,
    of ``width`` numbers a row, would not fit into memory together."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if at_once is None:
        at_once = 8 * slots * MANY_ROWS * 20 // max(1, df.count() * width)
    with ThreadPoolExecutor(max_workers=max(1, min(slots, at_once))) as pool:
        return list(pool.map(fit, jobs))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder), so a lost
    executor re-reads the stored result instead of replaying the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
