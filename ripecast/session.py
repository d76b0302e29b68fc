"""Session settings the plans rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. AQE coalesces small shuffle partitions, splits skewed join and
# rebalance partitions, and turns a sort-merge join into a broadcast join when the measured side is small.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "ripecast", master: str | None = None, shuffle_gb: float | None = None, **conf: str
) -> SparkSession:
    """Create (or get) a session; ``conf`` keys use ``__`` in place of dots.

    ``shuffle_gb`` is the size of the largest shuffle to expect. AQE starts from a partition per 128 MB of it and merges
    small ones; Spark's own default of 200 is an upper limit that large inputs outgrow.
    """
    if shuffle_gb is not None:
        first = str(max(200, int(shuffle_gb * 8)))
        conf = {"spark__sql__adaptive__coalescePartitions__initialPartitionNum": first, **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, or None when it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def checkpoints(spark: SparkSession) -> str:
    """The checkpoint folder. On a single machine one is made where the session names none; a cluster must name one that
    all executors share."""
    if not checkpoint_dir(spark):
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ripecast-"))
    return checkpoint_dir(spark)
