"""Session helpers: a tuned local session for tests/bench, size checks, checkpoints."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
#: Bytes of files and of rows a shard at most. A task that turns a shard's texts into postings holds some 50 times as
#: much (one row a document and term, in a hash table or a sort). Files alone say little: a dictionary or compression
#: stores repeated texts once.
SHARD_BYTES = 8 * 1024 * 1024
_UNKNOWN_BYTES = 1 << 60  # what Spark reports for sources without statistics


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "rankfold") -> SparkSession:
    """Session used by tests and the bench. On a cluster, pass the existing session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RANKFOLD_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment and only read here; a
    missing setting raises there. A scratch folder is made only in local mode
    (one machine), where it is shared by definition.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="rankfold-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written intermediate table."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: one aggregate of partial sums, no rows move.

    Bytes count the values of strings and arrays, 8 for any other column, and
    16 a row.
    """
    width = F.lit(16).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind == "array<string>":
            width = width + F.coalesce(F.octet_length(F.concat_ws("", c)) + 8 * F.size(c), F.lit(0))
        elif kind.startswith("array<"):
            width = width + 8 * F.greatest(F.size(c), F.lit(0))
        else:
            width = width + 8
    n, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return n, size or 0


def fits(df: DataFrame, max_rows: int | None = None, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` may be broadcast: at most ``max_rows`` rows and ``max_bytes`` bytes."""
    n, size = table_size(df)
    return size <= max_bytes and (max_rows is None or n <= max_rows)


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files ``df`` is read from, by plan statistics; None when a source has none.

    Nothing runs. Joins and aggregations above the scans don't change it.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(s >= _UNKNOWN_BYTES for s in sizes) else sum(sizes)


def _split_bytes(spark: SparkSession) -> int:
    conf = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
    return conf.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


class Owner:
    """What a block of code has written (tables and folders), to be removed together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables, self.paths = spark, [], []

    def drop(self) -> None:
        """Remove everything owned; what reads it fails afterwards."""
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        for p in self.paths:
            remove_path(self.spark, p)
        self.tables, self.paths = [], []


_OWNERS: ContextVar[tuple[Owner, ...]] = ContextVar("rankfold_owners", default=())


@contextmanager
def owned(spark: SparkSession, drop: bool = True):
    """Everything ``materialize`` and ``materialize_bucketed`` write inside belongs to the yielded owner.

    With ``drop`` it is removed at the end of the block; otherwise when the owner's ``drop`` is called.
    """
    owner = Owner(spark)
    token = _OWNERS.set((*_OWNERS.get(), owner))
    try:
        yield owner
    finally:
        _OWNERS.reset(token)
        if drop:
            owner.drop()


def _record(path: str, table: str | None = None) -> None:
    for owner in _OWNERS.get():
        owner.paths.append(path)
        if table:
            owner.tables.append(table)


def materialize(df: DataFrame, name: str, partition_cols: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the whole upstream plan) and lets several branches of a plan share one
    computation. Each call writes a fresh sub-folder.
    """
    import uuid

    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    _record(path)
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin repartition when a scan yields fewer partitions than cores.

    A single large parquet row group is read by one task; spreading it lets
    every core tokenise. On a cluster, inputs have far more splits than cores
    and this is a no-op.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism * factor
    size = input_bytes(df)
    if size is not None and size < target * _split_bytes(spark):
        return df.repartition(target)
    return df


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table bucketed by ``key`` under the shared checkpoint folder.

    Reading it back keeps the hash partitioning on ``key`` known to the planner:
    joins and aggregations on ``key`` (or on key sets containing it) need no
    exchange. If ``df`` is already hash-partitioned on ``key`` into ``buckets``
    partitions, each task writes a single file and nothing is shuffled.
    """
    import uuid

    spark = df.sparkSession
    table = f"rankfold_{name}_{uuid.uuid4().hex[:12]}"
    path = checkpoint_path(spark, table)
    _record(path, table)
    df.write.bucketBy(buckets, key).option("path", path).mode("overwrite").saveAsTable(table)
    return spark.table(table)


def default_shards(spark: SparkSession, df: DataFrame | None = None, row_bytes: int = 0) -> int:
    """Shard count for document-partitioned tables.

    Grows with the input without an upper limit (two shards per
    ``maxPartitionBytes`` of files, one per ``SHARD_BYTES`` of files or of
    ``row_bytes``, as ``table_size`` counts them), so that a task's memory stays
    the same, and never below two tasks per core so uneven documents leave no
    core idle. Inputs whose files have no known size take the shuffle partition
    setting, or more by their rows.
    """
    floor = max(2 * spark.sparkContext.defaultParallelism, -(-row_bytes // SHARD_BYTES))
    size = None if df is None else input_bytes(df)
    if size is None:
        return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(floor, -(-size // max(1, min(_split_bytes(spark) // 2, SHARD_BYTES))))


def ship_package(spark: SparkSession) -> None:
    """Make ``rankfold`` importable in every Python worker (``addPyFile`` of a zip).

    Pandas UDFs and ``mapInPandas`` functions are pickled by reference to this
    package; workers started outside the repository (or on other hosts) need
    it shipped, as ``--py-files`` would. Done once per SparkContext.
    """
    import uuid
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_rankfold_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    ckpt = ensure_checkpoint_dir(spark)
    local = ckpt if "://" not in ckpt or ckpt.startswith("file:") else tempfile.gettempdir()
    local = local.replace("file://", "").replace("file:", "")
    os.makedirs(local, exist_ok=True)
    path = os.path.join(local, f"rankfold-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    sc._rankfold_shipped = True
