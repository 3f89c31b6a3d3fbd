"""Session helpers: the settings every query relies on.

Time semantics are wall-clock in UTC (the history tables carry local
wall-clock times without a zone), so the session time zone is pinned to UTC.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators depend on for correct results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for efficiency; applied only when a session is built here.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[*]", app: str = "spanlog",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Build (or get) a session with the engine defaults. For tests and bench."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf.update(REQUIRED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session given by a caller."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster (a shared file system); it is read
    from the session. Only when it is unset and Spark runs in one process
    (local tests) a scratch folder is created and registered; on a cluster, where
    machines do not share a local folder, a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all machines")
        d = tempfile.mkdtemp(prefix="spanlog-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for an intermediate table."""
    base = shared_dir(spark).rstrip("/")
    import uuid
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint in the shared folder (never a local one)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
