"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Only for sessions that run here (``local[...]``); a deployment's own settings always stand.
LOCAL_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
              "spark.sql.session.timeZone": "UTC"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "orderpulse", extra: dict | None = None) -> SparkSession:
    """A session that sets what the caller asks for and nothing else."""
    builder = SparkSession.builder.appName(app_name)
    conf = dict(LOCAL_CONF) if master and master.startswith("local") else {}
    if master:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every executor.
    Only when it is unset and everything runs on this machine (unit tests, a laptop) do we
    pick a folder ourselves; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/orderpulse/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it names (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """Write one small text file (e.g. a commit record): written under a hidden temporary
    name in the same folder, then renamed, so readers never see a partial file."""
    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tmp = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise OSError(f"could not publish {path}")


def read_small_file(spark: SparkSession, path: str) -> str | None:
    """The text of one small file (e.g. a checkpoint's metadata), or None where there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (``addPyFile`` of a zip of it), once
    per application. Needed by the operators that run Python in tasks (``mapInPandas``,
    ``applyInPandasWithState``): executors do not share the driver's ``sys.path``."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="orderpulse-pkg-"), "orderpulse.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on its file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
