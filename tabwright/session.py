"""SparkSession factory for tests and the bench; on a cluster the caller brings the session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "tabwright", **conf: str) -> SparkSession:
    """A local session with AQE, UTC and few shuffle partitions. Extra settings: ``**{"key": "value"}``."""
    # Python workers import this package, so its folder has to be on their path.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([root, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]))
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder that driver and executors share: spark.checkpoint.dir; a local session without one gets its own."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or (current.get() if current.isDefined() else None)
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="tabwright-")
    if not current.isDefined():
        context.setCheckpointDir(found)
    return found


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, whose files go when the driver ends."""
    folder = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder
