"""Session helpers.

The library never creates its own cluster settings beyond what a job needs:
AQE on (runtime coalescing and skew-join splitting), Arrow on for the one
Arrow-based HTML step, and a checkpoint folder taken from the session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "trawl") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TRAWL_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system).  Only a local-mode session without the setting gets a fresh
    temporary folder, as in tests.
    """
    conf_dir = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set; a cluster job needs a shared checkpoint folder")
        conf_dir = tempfile.mkdtemp(prefix="trawl-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def stage_dir(spark: SparkSession, job: str = "stages") -> str:
    """A fresh folder for one run's stages under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/trawl-{job}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh folder under the shared checkpoint folder and read back."""
    path = f"{stage_dir(df.sparkSession, name)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_status(spark: SparkSession, path: str) -> tuple[int | None, int | None]:
    """(length, modification time) of a path through its Hadoop file system; (None, None) if absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None, None
    st = fs.getFileStatus(hpath)
    return st.getLen(), st.getModificationTime()


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether the path is a folder of its Hadoop file system."""
    fs, target = _fs(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename through the Hadoop file system; False if ``dst`` already exists."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(conf)
    if fs.exists(d):
        return False
    return bool(fs.rename(s, d))


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file through the Hadoop file system: beside it first, then renamed over it."""
    fs, target = _fs(spark, path)
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.tmp-{uuid.uuid4().hex[:12]}")
    out = fs.create(tmp)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(tmp, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text through the Hadoop file system; None if it is absent."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file this library has written."""
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Python steps are pickled by reference, so workers must be able to import
    the package; where it is not installed on them (or on their path), a zip
    of its sources travels through ``addPyFile``.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_trawl_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="trawl-src-"), "trawl_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("trawl", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._trawl_shipped = True
