"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run should have; cluster submitters keep their own sizing.
# Static auto-broadcast is off: it trusts size *estimates* (compressed file sizes, or
# products of them across joins), which can put the large side of a join into memory.
# Broadcasts are then either explicit behind a row-count check (bounded_broadcast) or
# chosen by AQE from the *measured* size of a finished stage.
RECOMMENDED_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "footfall",
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the submitter (a shared file system).  Only when
    it is unset, as in local tests, a fresh local folder is created and recorded.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on a shared file system; "
                             "a machine-local folder does not survive a lost executor")
        root = tempfile.mkdtemp(prefix="footfall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root (never reused, never cleared)."""
    return f"{checkpoint_root(spark)}/footfall/{name}-{uuid.uuid4().hex[:12]}"
