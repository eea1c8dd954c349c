"""Helpers the corpus operators share: words, Arrow mapping, stages, id filters.

A *word* is a maximal run of characters other than space and the ASCII
controls 9-13 (``[^\\x20\\x09-\\x0D]+``).  ``bytes.split()`` cuts UTF-8 text at
exactly those six bytes, so ``words`` needs no regular expression.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import ensure_checkpoint_dir

WORD_CACHE = 120_000  # words a Python worker remembers before it starts over


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared ``spark.checkpoint.dir`` and read it
    back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()
BATCH_ROWS = 1000  # whole texts to a Python worker at once; Spark's 10,000 are for short rows


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that tasks run are imported there, not pickled, so that what a
    Python worker remembers (memos, vocabularies) lasts from task to task.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    package = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{package}-"), f"{package}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(package, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def map_rows(df: DataFrame, fn: Callable[..., Iterable[tuple]], schema: str,
             chunk: int = 4096, setup: Callable[[], object] | None = None) -> DataFrame:
    """``mapInArrow`` for functions that turn one input row into output tuples.

    ``fn`` gets the input columns' Python values (after ``setup()``'s result,
    when given) and returns output tuples.  Output leaves in batches of about
    ``chunk`` rows, so a task holds one batch at a time.
    """
    ship(df.sparkSession)
    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    names = spark_schema.fieldNames()
    types = [_arrow_type(f.dataType) for f in spark_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (setup(),) if setup else ()
        out: list[tuple] = []
        for b in batches:
            cols = [values(c) for c in b.columns]
            for row in zip(*cols, strict=True):
                out.extend(fn(*state, *row))
                if len(out) >= chunk:
                    yield arrow_batch(out, names, types)
                    out = []
        if out:
            yield arrow_batch(out, names, types)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def map_chunks(df: DataFrame, fn: Callable[..., Iterable[tuple]], schema: str, chunk: int,
               setup: Callable[[], object]) -> DataFrame:
    """``map_rows`` for functions that work on ``chunk`` rows at a time: ``fn`` gets
    ``setup()``'s result and a list per input column."""
    ship(df.sparkSession)
    spark_schema = df.sparkSession.createDataFrame([], schema).schema
    names = spark_schema.fieldNames()
    types = [_arrow_type(f.dataType) for f in spark_schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup()
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                out = fn(state, *map(values, b.slice(at, chunk).columns))
                yield arrow_batch(list(out), names, types)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def values(col: pa.Array) -> list:
    t = col.type
    if pa.types.is_list(t) and pa.types.is_integer(t.value_type) and not col.null_count:
        flat, offs = col.flatten().to_numpy(zero_copy_only=False), col.offsets.to_numpy()
        offs = offs - offs[0]
        return [flat[offs[i]:offs[i + 1]] for i in range(len(col))]
    return col.to_pylist()


def arrow_batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = []
    for values, t in zip(zip(*rows, strict=True), types, strict=True):
        if pa.types.is_list(t) and all(isinstance(v, np.ndarray) for v in values):
            offs = np.zeros(len(values) + 1, np.int32)
            np.cumsum([len(v) for v in values], out=offs[1:])
            flat = np.concatenate(values)
            arrays.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, t.value_type)))
        else:
            arrays.append(pa.array(values, t))
    return pa.RecordBatch.from_arrays(arrays, names)


def _arrow_type(t) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words after lower-casing A-Z alone (``bytes.lower`` touches only ASCII)."""
    return text.encode().lower().split() if text else []


#: ASCII letters stay (lower-cased), other ASCII becomes a space; the bytes of
#: non-ASCII characters stay and count as letters.
_LETTERS = bytes(c if c >= 128 else c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32
                 for c in range(256))


def letter_runs(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, as UTF-8."""
    return text.lower().encode().translate(_LETTERS).split() if text else []


_HASHES: dict[bytes, int] = {}


def forget() -> None:
    """Drop the hashes that a Python worker remembers; for operators that need its
    memory for a memo of their own."""
    _HASHES.clear()


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """64-bit hash of every word; a bounded memo saves hashing common words again."""
    memo = _HASHES
    if len(memo) > WORD_CACHE:
        memo.clear()
    out = list(map(memo.get, ws))
    if None in out:
        h = xxhash.xxh3_64_intdigest
        for i, v in enumerate(out):
            if v is None:
                w = ws[i]
                memo[w] = out[i] = h(w)
    return np.array(out, np.uint64)


_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that sums of products look random."""
    h = h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes.

    The polynomial sum of a run, mixed; doubling keeps it at log2(k) passes
    whatever ``k`` is.
    """
    if len(h) < k:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        n = len(h) - k + 1
        acc, done, power, block, width, rest = None, 0, np.uint64(1), h, 1, k
        step = _MULT
        while rest:
            if rest & 1:
                part = block[done:done + n] * power
                acc = part if acc is None else acc + part
                done += width
                power = power * step
            rest >>= 1
            if rest:
                block = block[:len(block) - width] + block[width:] * step
                width *= 2
                step = step * step
        return mix(acc)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def with_id(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone.  A row without ``doc_id`` can't be named
    in a result and is left out."""
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")


def fold_bucket(doc_id) -> F.Column:
    """crc32 of the id as text, mod 5: 0 is the held-out fold."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5))


SMALL_ROWS = 1_000_000  # of one or two integers: 16 MB


def if_small(ids: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Mark a staged table of ids for broadcast when its counted size allows;
    otherwise the join stays a plain shuffle join.  Results are the same."""
    return F.broadcast(ids) if ids.count() <= rows else ids


def running(df: DataFrame, order: list[str], weight: str, name: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``weight`` (a long, not null) over all
    rows that precede a row in ascending ``order``.

    Rows are dealt by range and sorted, every task keeps a running sum over its
    range, and the sums of the ranges (one row per task) place the ranges.  No
    group or window holds more than that.  Rows equal in ``order`` precede one
    another in any order, so ``order`` should name every row or tie only rows
    that are alike.  ``df`` is read twice (range bounds, then the rows): pass a
    staged table.  The result is staged.
    """
    spark = df.sparkSession
    ship(spark)
    at = df.columns.index(weight)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            w = b.column(at).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(w)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(w), part, np.int32)), pa.array(ends - w)],
                [*b.schema.names, "part", "within"])
            total = int(ends[-1]) if len(w) else total

    schema = StructType([*df.schema.fields, StructField("part", IntegerType()),
                         StructField("within", LongType())])
    placed = stage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(sums, schema), name)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy("part").agg(F.sum(weight).alias("t"))
             .select("part", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("shift")))
    return (placed.join(F.broadcast(parts), "part")  # one row per task of the stage
            .withColumn("before", F.col("within") + F.col("shift"))
            .drop("part", "within", "shift"))
