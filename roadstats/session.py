"""Session construction and shared working folders."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Settings the engine relies on. Simulation time maps to epoch seconds, so timestamps are
#: shown in UTC; AQE coalesces the shuffle partitions of the (small) read queries and
#: splits skewed ones.
ENGINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "roadstats",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine settings.

    ``master`` is left to ``spark-submit`` when None. ``shuffle_partitions`` should be sized
    to the data (about 128-256 MB of shuffle input per partition); on a cluster AQE
    coalesces anything smaller.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide shared folder for lineage cuts, stream checkpoints and sink output.

    Read from ``spark.checkpoint.dir`` (session or context conf). Only a ``local`` master (a
    test run) without one gets a fresh local folder, registered with
    ``SparkContext.setCheckpointDir`` and reused for the life of the application. On any other
    master executors would each write to their own disk, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
    app = sc.applicationId
    if app not in _LOCAL_ROOTS:
        local = tempfile.mkdtemp(prefix="roadstats-ckpt-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(local)
        _LOCAL_ROOTS[app] = local
    return _LOCAL_ROOTS[app]


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root (one per run; never reused)."""
    return f"{shared_root(spark)}/roadstats/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` or plain paths, None for remote schemes."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return os.path.abspath(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop-compatible) filesystem."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hpath)]


def folder_stamp(spark: SparkSession, path: str) -> str:
    """Length, number of files and modification time of ``path`` (two calls, no loop over files)."""
    fs, hpath = _fs(spark, path)
    summary, status = fs.getContentSummary(hpath), fs.getFileStatus(hpath)
    return f"{status.getPath()}|{summary.getLength()}|{summary.getFileCount()}|{status.getModificationTime()}"


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under ``path``."""
    fs, hpath = _fs(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def modified_at(spark: SparkSession, path: str) -> float:
    """Modification time of ``path`` in epoch seconds."""
    fs, hpath = _fs(spark, path)
    return fs.getFileStatus(hpath).getModificationTime() / 1000.0


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is below it."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small UTF-8 file on the shared filesystem, None when nothing was written.

    An empty file is one whose writer died after it was created; it is passed over for the next
    attempt at the same name (``write_small_text``).
    """
    for name in _attempts(path):
        fs, hpath = _fs(spark, name)
        if not fs.exists(hpath):
            return None
        stream = fs.open(hpath)
        try:
            jvm = spark.sparkContext._jvm
            text = str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if text:
            return text
    return None


def write_small_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small UTF-8 file unless one was written before; False when there is one.

    The text goes to a file of its own, which then gets its name in one step that fails if the
    name is taken, so of two writers one wins and no reader sees half a file. A name taken by an
    empty file (a writer of an older version that died) is left, and the next attempt's is used.
    """
    if not text:
        raise ValueError("an empty file counts as never written")
    for name in _attempts(path):
        fs, hpath = _fs(spark, name)
        if not fs.exists(hpath):
            if _publish(spark, name, text):
                return True
        if fs.getFileStatus(hpath).getLen() > 0:
            return False
    return False


def _attempts(path: str) -> Iterator[str]:
    yield path
    for n in itertools.count(1):
        yield f"{path}.{n}"


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Write ``text`` beside ``path`` and name it so; False if the name was taken meanwhile."""
    from py4j.protocol import Py4JJavaError

    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex[:12]}"
    fs, hdraft = _fs(spark, draft)
    out = fs.create(hdraft, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    try:
        if fs.getScheme() == "file":
            # A local rename replaces its target; a hard link does not.
            os.link(hdraft.toUri().getPath(), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)).toUri().getPath())
            return True
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hdraft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(fs.makeQualified(hdraft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(hdraft, False)
