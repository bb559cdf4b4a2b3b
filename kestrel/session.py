"""Session helpers: a tuned SparkSession, table loading and a shared scratch folder.

Nothing here changes query semantics; it only fixes the settings every job in this
library assumes (UTC session zone, AQE on, Arrow for pandas functions).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


#: Rows of a partition that a tree fit keeps as objects (some 200 to 500 bytes each).
FIT_ROWS = 1_000_000


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kestrel", event_log_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library is tuned for.

    On a cluster, leave ``master`` unset: the shuffle width is then the cluster's own
    setting (size it to the data; AQE coalesces small partitions and splits skewed ones at
    runtime). A width from the CPU count is only taken for a local master. Checkpoints are
    removed once nothing refers to them.
    ``event_log_dir`` turns on Spark's event log there (stage and task times without
    the web UI).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if shuffle_partitions or (master or "").startswith("local"):
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
          # sessions merge inside each input partition before the shuffle: a key with a large
          # share of the events arrives at its reducer as sessions, not raw rows
          .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "16g")))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver tables (Parquet; filters and projections push down)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` when the session names one. Where it is
    unset, a local master (tests) gets a local folder, registered with ``setCheckpointDir``
    and removed when Python exits; any other master raises, as its executors would not
    see a local folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    jdir = sc._jsc.sc().getCheckpointDir()
    if conf_dir:
        if jdir.isEmpty():
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not jdir.isEmpty():
        # setCheckpointDir appends a per-application uuid folder; its parent is ours.
        return jdir.get().rsplit("/", 1)[0].replace("file:", "", 1)
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, task_rows: int | None = None) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss).

    With ``task_rows`` no partition holds many more rows than that: where one does, the rows are
    dealt out evenly and stored again. Fits keep a partition's rows as objects, far larger than the
    file splits or shuffle bytes that made it, so its size has to be bounded in rows.
    """
    scratch_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    if task_rows is None:
        return out
    sizes = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    total, most = sizes.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) <= task_rows:
        return out
    return out.repartition(max(out.rdd.getNumPartitions(), -(-total // task_rows))).checkpoint(eager=True)
