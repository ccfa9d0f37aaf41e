"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankfold.session import ensure_checkpoint_dir, materialize, ship_package

#: Characters that separate words.
SPACES = " \t\n\x0b\x0c\r"


#: Rows and bytes of an Arrow batch at most: a batch of whole texts is held by the JVM and by Python, several times over.
BATCH_ROWS, BATCH_BYTES = 1_000, 2 * 1024 * 1024


def prepare(spark: SparkSession) -> None:
    """Set up what every operator needs: the shared folder, and this package on the executors."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


@contextmanager
def small_batches(spark: SparkSession):
    """While it lasts, Arrow batches of bounded rows and bytes; the session's own settings come back after it."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, most in limits.items():
        spark.conf.set(k, str(most))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded rows and, about, bytes (one row at least), whatever the session's batches are."""
    step = max(1, min(BATCH_ROWS, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def free_executors(spark: SparkSession) -> None:
    """Have the executors collect garbage and give the heap they don't need back to the system.

    An executor's heap grows to its limit over a long job, whatever lives in it, and what a stage needs beside the
    heap (Python workers, Arrow buffers) comes on top. Called between stages, from which nothing lives on.
    """
    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: cuts the lineage, computed once."""
    with small_batches(df.sparkSession):
        return materialize(df, f"llm-{name}")


def text_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so further columns of any name never clash with an operator's own."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


_STATE: dict = {}


def shared_state(key: tuple, make: Callable):
    """A task's state that the next task of the same operator in this worker process takes over.

    One operator's at a time: another operator's tasks let it go, so it doesn't add to their memory.
    """
    if key not in _STATE:
        _STATE.clear()
        _STATE[key] = make()
    return _STATE[key]


def forget() -> None:
    """Let go of what another operator's tasks have left in this worker process."""
    if _STATE:
        _STATE.clear()
        hand_back()


def hand_back() -> None:
    """What a task has freed goes back to the system: a Python worker outlives its tasks, and allocators keep free memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[..., dict], schema: str, init: Callable | None = None) -> DataFrame:
    """``mapInArrow`` where ``fn(state, columns as lists by name)`` returns output columns by name, or yields them in parts."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = init() if init else None
        if not any(state is x for x in _STATE.values()):
            forget()
        for batch in batches:
            for part in slices(batch):
                cols = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                got = fn(state, cols)
                for out in (got,) if isinstance(got, dict) else got:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in target], schema=target)
        state = batch = part = cols = got = out = None
        hand_back()

    return df.mapInArrow(run, schema)


_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place: neighbouring counters give independent-looking values."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def counter_hash(key, *counters) -> np.ndarray:
    h = np.atleast_1d(np.asarray(key, np.uint64))
    for c in counters:
        h = mix(h + np.atleast_1d(c).astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(0x632BE59BD9B4E019))
    return h


def to_unit(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def uniform(key, *counters) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and the counters only."""
    return to_unit(counter_hash(key, *counters))


#: Ids up to this many rows (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 4_000_000


def ids_side(ids: DataFrame) -> DataFrame:
    """A one-column table of ids, marked for broadcast if it is known to be small."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
