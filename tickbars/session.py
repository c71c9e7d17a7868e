"""Session and storage-location helpers.

Work that must survive executor loss writes to the shared folder named by
``spark.checkpoint.dir``.  The folder is read from the session; a private
temporary folder is only created when the setting is absent (unit tests,
a laptop).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings every job wants.  Only SQL settings that are safe at runtime are
# applied to an existing session; static ones go through the builder.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # commit only the state changes of a micro-batch (snapshots in the background)
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # sessions merge inside a task before the shuffle, so a busy feed moves few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    app: str = "tickbars",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session created elsewhere.  A setting the
    session refuses is reported by its own error: running on without the state
    store or the time zone asked for would give other results."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


_FALLBACK_ROOT: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Falls back to a fresh local temporary folder only when the setting is
    unset and the master is local, which is the unit-test / laptop case (a core
    setting cannot be set at runtime, so the fallback is remembered per
    application).  On any other master a machine-local folder would not be
    seen by the executors, so the missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        root = _FALLBACK_ROOT.get(sc.applicationId)
        if not root:
            root = tempfile.mkdtemp(prefix="tickbars-")
            _FALLBACK_ROOT[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root for one run."""
    path = f"{shared_root(spark)}/tickbars/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = _hadoop_path(spark, path)
    fs.mkdirs(p)
    return path


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of any URI or plain path, by Hadoop's own rules."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tickbars`` importable in Python workers (stateful processors,
    pandas UDFs): the package is zipped in memory, written into the shared
    folder once per application and added with ``addPyFile``."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("tickbars", os.path.relpath(full, pkg)))
    target = f"{fresh_path(spark, 'pyfiles')}/tickbars.zip"
    fs, path = _hadoop_path(spark, target)
    out = fs.create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared folder and read it
    back: cuts the lineage (an executor loss later does not recompute the
    upstream) and lets a consumer that reads its input several times read
    the table instead of re-running the upstream.  The write's shuffle files
    are dropped when it ends, since nothing reads them again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote and nothing reads any more."""
    spark = df.sparkSession
    root = shared_root(spark).split(":", 1)[-1].lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if f"/{root}/tickbars/" in "/" + folder.split(":", 1)[-1].lstrip("/") + "/":
            fs, path = _hadoop_path(spark, folder)
            fs.delete(path, True)
