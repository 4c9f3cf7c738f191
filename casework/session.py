"""SparkSession construction and job-safety helpers.

The library never creates its own session inside an operator; callers pass
one in.  ``get_session`` is for tests, the bench and the driver entry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Conf keys the jobs rely on.  Values here are only defaults: whatever the
# submitter has set wins, and the LOCAL_ONLY ones are never set off a local master.
LOCAL_ONLY = {"spark.sql.shuffle.partitions", "spark.driver.memory"}
LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep one task per core for CPU-heavy stages after small shuffles
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # Wide rule projections generate methods above HotSpot's 8 KB JIT limit;
    # let the JIT compile them instead of interpreting them per row.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def submitted_conf() -> dict[str, str]:
    """Settings made outside this code: by spark-submit (the JVM is up then),
    or in PYSPARK_SUBMIT_ARGS."""
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        from pyspark import SparkConf, SparkContext
        SparkContext._ensure_initialized()
        return dict(SparkConf().getAll())
    import shlex
    words, out = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", "")), {}
    for flag, value in zip(words, words[1:]):
        if flag in ("--conf", "-c"):
            key, _, out_value = value.partition("=")
            out[key] = out_value
        elif flag == "--master":
            out["spark.master"] = value
        elif flag == "--driver-memory":
            out["spark.driver.memory"] = value
    return out


def get_session(master: str | None = None, app: str = "casework", **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` given here beats them, and
    what was submitted beats both."""
    builder = SparkSession.builder.appName(app)
    submitted = submitted_conf()
    master = submitted.get("spark.master", master)
    if master:
        builder = builder.master(master)
    local = not master or is_local(master)
    for k, v in {**LOCAL_DEFAULTS, **conf}.items():
        if k not in submitted and (local or k in conf or k not in LOCAL_ONLY):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system Spark knows exists."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def table_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, latest change) below a path: changes when the table does."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(where, True)
    n = size = latest = 0
    while files.hasNext():
        status = files.next()
        n, size, latest = n + 1, size + status.getLen(), max(latest, status.getModificationTime())
    return n, size, latest


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to a shared filesystem; we only fall
    back to a fresh scratch folder when it is unset (local tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="casework-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor
    (once per application), wherever the driver found it."""
    import shutil
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(here):  # else it came as a --py-files archive and is there already
        root = tempfile.mkdtemp(prefix="casework-py-")
        shutil.copytree(here, os.path.join(root, "pkg", "casework"), ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(os.path.join(root, "casework_py"), "zip", os.path.join(root, "pkg")))
    _SHIPPED.add(sc.applicationId)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_table(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared checkpoint
    folder and return a read of it: lineage is cut, and later readers get
    columnar scans with column pruning and predicate pushdown (a reliable
    RDD checkpoint would be row-serialised).  A fresh path per call, so a
    plan never reads and overwrites the same files."""
    import uuid
    root = ensure_checkpoint_dir(df.sparkSession)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
