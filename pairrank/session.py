"""Session defaults, the shared checkpoint folder and table materialisation.

Iterative training and the distributed ranking both need data that is fixed
once computed.  Lineage is cut by writing parquet into the folder the cluster
names in ``spark.checkpoint.dir``; a machine-local folder is only invented
when the session runs in local mode and nothing is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUN_ID = uuid.uuid4().hex[:12]


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "pairrank") -> SparkSession:
    """A local session with the settings tests and the bench use."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialised tables.

    Read from ``spark.checkpoint.dir`` (or a directory already given to
    ``setCheckpointDir``).  Only a local-mode session without one gets a fresh
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="pairrank-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the checkpoint root for this process."""
    return f"{checkpoint_root(spark)}/pairrank/{_RUN_ID}/{name}-{uuid.uuid4().hex[:8]}"


# Shuffled bytes that adaptive execution puts into one task of a written table, unless few tasks have less.
TASK_BYTES = "8m"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """Jobs inside run with a setting; the session's own comes back after."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def small_tasks(spark: SparkSession):
    """Jobs inside merge shuffle partitions only up to ``TASK_BYTES``.

    Numbers shrink in a shuffle to a tenth of what sorts and hash tables hold
    of them: tasks of the usual size spill.
    """
    return _setting(spark, _ADVISORY, TASK_BYTES)


def dropped_shuffles(spark: SparkSession):
    """Actions begun inside leave no shuffle files.

    Otherwise these stay on the executors' disks until the driver happens to
    collect its garbage, those of every table written so far beside one another.
    """
    return _setting(spark, _DROPPED, "true")


# Tables of numbers take a quarter less room by this than by the session's codec.
NUMBERS = "zstd"


def write_table(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back."""
    with dropped_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.parquet(path)


_SCOPES: list[list[str]] = []


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    The result has no lineage beyond the files, so recomputation after an
    executor loss re-reads them instead of re-running (and possibly re-drawing)
    the plan that produced them.
    """
    path = scratch_path(df.sparkSession, name)
    out = write_table(df, path, codec)
    for scope in _SCOPES:
        scope.append(path)
    out._scratch_path = path
    return out


def materialise_small(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` by ``small_tasks``: for tables of numbers."""
    with small_tasks(df.sparkSession):
        return materialise(df, name, NUMBERS)


@contextmanager
def intermediate_tables(spark: SparkSession):
    """Delete the tables materialised inside the block when it ends.

    Yields a list; append the DataFrames (returned by ``materialise``) that
    must outlive the block.  Everything else written in the block is removed,
    so a finished step leaves only its results in the shared folder.
    """
    created: list[str] = []
    keep: list[DataFrame] = []
    _SCOPES.append(created)
    try:
        yield keep
    finally:
        _SCOPES.pop()  # scopes end in the reverse order of their beginning
        kept = {getattr(df, "_scratch_path", None) for df in keep}
        for path in created:
            if path not in kept:
                delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a materialised table through the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hpath, True)


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in one move: it is there whole or not at all."""
    part, fs = _file_system(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, _file_system(spark, path)[0]):
        fs.delete(part, False)
        raise OSError(f"could not put {path} in place")


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    return spark.read.text(path, wholetext=True).first()[0]


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    hpath, fs = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(hpath)) if fs.exists(hpath) else []


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by Python workers (the ``--py-files`` way).

    Zips the package once per application and adds it with ``addPyFile``, which
    distributes it to every executor, current and future.  The archive is only
    a driver-side staging file served by Spark (as ``spark-submit --py-files``
    does); no executor reads the driver's folder, and no data goes there.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="pairrank-pyfiles-")
    archive = os.path.join(out_dir, "pairrank.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in folder:
                continue
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
