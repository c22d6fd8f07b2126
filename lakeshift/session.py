"""Session helpers: where shared work folders live, and a test/local session.

Snapshots, stream checkpoints and lineage cuts go under the folder named by
``spark.checkpoint.dir`` - on a cluster that is a shared store every executor
can reach. Only a local-mode session with the setting unset (tests) gets a
private folder made here.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def work_root(spark: SparkSession) -> str:
    """The shared folder for everything this library writes besides targets."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is unset; point it at a shared folder "
                "(for example an object-store prefix) before running on a cluster"
            )
        root = tempfile.mkdtemp(prefix="lakeshift-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under :func:`work_root`."""
    return f"{work_root(spark)}/lakeshift/{name}-{uuid.uuid4().hex[:12]}"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "lakeshift",
    event_log_dir: str | None = None,
) -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, UTC session zone, and a
    private warehouse folder (a local session only; clusters configure theirs)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakeshift-warehouse-"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.eventLog.enabled", "true" if event_log_dir else "false")
        .config("spark.eventLog.dir", event_log_dir or "")
        .config("spark.eventLog.compress", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for a path, through the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (metadata listing only)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isFile())


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (parents included)."""
    fs, p = hadoop_fs(spark, path)
    fs.create(p, True).close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file (metadata), replacing what is there."""
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_small(spark: SparkSession, path: str) -> str | None:
    """What :func:`write_small` wrote; None if there is no such file."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
