"""Session helpers: a local session for tests/bench and a cluster-safe scratch location.

Scratch data (staging tables, stream checkpoints, written bronze layers) always lives under the
folder named by ``spark.checkpoint.dir`` so that on a cluster it is the shared file system every
executor sees.  Only when the session has no such setting (local tests) do we create one.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tidemark",
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session with the settings the tests and the bench use (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    A local folder is created only for a ``local[...]`` session without the setting (tests); on a
    cluster a machine-local folder would be invisible to the other executors and lost with its
    machine, so an unset ``spark.checkpoint.dir`` is an error there.
    """
    sc = _context(spark)
    current = (sc.getConf().get(CHECKPOINT_CONF, None) if sc else None) or spark.conf.get(CHECKPOINT_CONF, None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: point it at a shared folder (HDFS, S3, ...) that "
                               "every executor can reach; scratch and staging data are written there")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for one run of one job."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tidemark-scratch/{name}-{uuid.uuid4().hex[:12]}"


# --- file-system helpers: Hadoop's FileSystem (any scheme, default FS for bare paths) -------------

def _hadoop(spark: SparkSession, path: str):
    sc = _context(spark)
    if sc is None:
        return None, None
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(sc._jsc.hadoopConfiguration()), hpath


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return bool(fs.exists(hpath)) if fs is not None else os.path.exists(_local(path))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (scheme and authority), for comparing paths."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        return "file:" + os.path.abspath(_local(path.replace("file://", "file:")))
    return fs.makeQualified(hpath).toString().rstrip("/")


def list_names(spark: SparkSession, path: str, dirs_only: bool = False) -> list[str]:
    """Names of the entries directly under ``path`` (empty if it does not exist)."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        p = _local(path)
        if not os.path.isdir(p):
            return []
        return [n for n in os.listdir(p) if not dirs_only or os.path.isdir(os.path.join(p, n))]
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath) if not dirs_only or st.isDirectory()]


def touch(spark: SparkSession, path: str) -> None:
    """Create (or replace) an empty marker file."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
        open(_local(path), "w").close()
        return
    fs.create(hpath, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file, or a folder that this package has written."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        if os.path.isdir(_local(path)):
            shutil.rmtree(_local(path))
        else:
            os.unlink(_local(path))
        return
    fs.delete(hpath, True)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file (configuration, not data) under a name of its own and rename it, so that it appears as a whole."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, hpath = _hadoop(spark, aside)
    if fs is None:
        os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
        with open(_local(aside), "w") as f:
            f.write(text)
        os.replace(_local(aside), _local(path))
        return
    out = fs.create(hpath, True)
    out.write(bytearray(text.encode()))
    out.close()
    target = _hadoop(spark, path)[1]
    if not fs.rename(hpath, target):   # a repeat meets the file of the run before
        fs.delete(target, False)
        fs.rename(hpath, target)


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        with open(_local(path)) as f:
            return f.read()
    stream = fs.open(hpath)
    try:
        return _context(spark)._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, path: str) -> int | None:
    """The size of the files under ``path`` (None if it does not exist)."""
    fs, hpath = _hadoop(spark, path)
    if fs is None:
        p = _local(path)
        if not os.path.isdir(p):
            return None
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(p) for f in files)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else None
