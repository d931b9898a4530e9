"""SparkSession settings shared by tests, bench and the job runner.

On a cluster the session comes from the platform; these helpers only fill in
what is unset so that local runs behave like the cluster plan (AQE on,
skew-join on, shuffle partitions sized to the cores).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes are per-partition targets, so they hold
# whatever the data volume: AQE coalesces small shuffles and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Broadcast only below a proven bound; anything larger goes sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpointed rows go from the shared folder once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stepfold", extra: dict | None = None) -> SparkSession:
    """A session with the defaults above. Under spark-submit the platform's master,
    memory and partition count stay as they are unless given here."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    builder = SparkSession.builder.appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master or not submitted:
        builder = builder.master(master or f"local[{cpus}]")
    if shuffle_partitions or not submitted:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    if not submitted:
        conf["spark.driver.memory"] = os.environ.get("STEPFOLD_DRIVER_MEMORY", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh folder of its own;
    on a cluster other hosts could not read it, so the setting is required.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="stepfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system; none there is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
