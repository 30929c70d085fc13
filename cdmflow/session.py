"""Session construction and the shared stage folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

_LOCAL_STAGE: dict[str, str] = {}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "cdmflow",
    checkpoint_dir: str | None = None,
    driver_memory: str = "8g",
) -> SparkSession:
    """Session for tests, the bench and notebooks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # batch jobs: no Python call-site capture on every Column operation (debugging aid)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would not be
    visible to other executors). Only a local-mode session without the setting
    gets a private temporary folder, as in tests.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_STAGE:
        _LOCAL_STAGE[key] = tempfile.mkdtemp(prefix="cdmflow-ckpt-")
        spark.sparkContext.setCheckpointDir(_LOCAL_STAGE[key])
    return _LOCAL_STAGE[key]


def stage_root(spark: SparkSession) -> str:
    """The folder of this application's lineage cuts under the checkpoint root."""
    return os.path.join(checkpoint_root(spark), "cdmflow-stage", spark.sparkContext.applicationId)


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for one lineage cut."""
    return os.path.join(stage_root(spark), f"{name}-{uuid.uuid4().hex}")


def drop_stages(spark: SparkSession) -> None:
    """Remove this application's stage folders, once no result reads them any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist on the session's file system (local, HDFS, object store)?

    Local paths are checked directly; any other URI by letting Spark list it.
    """
    if "://" not in path or path.startswith("file:"):
        return os.path.exists(path.removeprefix("file://").removeprefix("file:"))
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False
