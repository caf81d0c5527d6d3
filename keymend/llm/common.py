"""Shared pieces of the training-data operators: durable intermediate tables, Arrow text
chunks, vectorised word hashing and joins that survive hot keys."""

from __future__ import annotations

import atexit
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Raw text bytes handled at once by the numpy code; a longer document is handled alone.
CHUNK = 1 << 20
CHUNK_ROWS = 1024
#: A key counts as hot when it holds more than 1/HOT of the rows, so there are fewer than HOT hot keys.
HOT = 256

_RUN = uuid.uuid4().hex
_DIRS: dict[str, str] = {}


# --- durable intermediates ---------------------------------------------------------------

def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one `spark.checkpoint.dir` names, or one of
    our own under the warehouse where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{base.rstrip('/')}/keymend-{_RUN}"


def _forget(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit; the folder then stays for the cluster's own cleaner
        pass


def stash(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the lineage, survives
    lost executors and is never recomputed. Removed when the driver's process ends."""
    spark = df.sparkSession
    base = shared_dir(spark)
    if base not in _DIRS:
        _DIRS[base] = base
        atexit.register(_forget, spark, base)
    path = f"{base}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Remove tables that stash() wrote and that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_stash", None):
            _forget(t.sparkSession, path)


def arrow_batches(spark: SparkSession, rows: int = 1024, size: int = 64 << 20) -> None:
    """Keep Arrow batches small, since texts may be very long. Spark reads both settings when it runs the
    returned frame, so they stay set."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def n_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of the input for each bucket that a task holds whole, and the most buckets that a block sends to.
BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 200_000


def n_buckets(rows: DataFrame) -> int:
    """Buckets for what `rows` send each other: the shuffle partitions, or more where the files that `rows` are read
    from hold over BUCKET_BYTES for each. Sources of unknown size don't count. No job is run for it."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length())]
    size = sum(x for x in sizes if x < 2**62)  # Spark's stand-in for an unknown size is beyond
    return max(n_parts(rows.sparkSession), min(size // BUCKET_BYTES, MAX_BUCKETS))


# --- joins with hot keys -------------------------------------------------------------------

def attach(rows: DataFrame, table: DataFrame, on: str, total: int) -> DataFrame:
    """`rows` inner-joined with `table`, which has one row per key and that key's row count `cnt`.
    The fewer than HOT keys that hold over 1/HOT of all rows are joined by a broadcast of proven
    size; the others by an ordinary shuffle, where no key is hot any more. `cnt` is kept."""
    is_hot = F.col("cnt") * HOT > F.lit(total)
    hot = F.broadcast(table.filter(is_hot))
    return rows.join(hot, on).unionByName(
        rows.join(hot.select(on), on, "left_anti").join(table.filter(~is_hot), on)
    )


# --- Arrow text ----------------------------------------------------------------------------

def text_arrays(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string or binary column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


#: Stands for a null doc_id in numpy arrays: before all others.
NULL_ID = -(2**63)


def id_array(col: pa.Array) -> np.ndarray:
    """An integer column as int64, null as NULL_ID."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.int64())
    return (pc.fill_null(col, NULL_ID) if col.null_count else col).to_numpy(zero_copy_only=False)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def chunks(batches, text: str = "text", limit: int = CHUNK):
    """(batch slice, bytes, offsets) for runs of rows of about `limit` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = text_arrays(batch.column(batch.schema.get_field_index(text)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            j = min(j, n, i + CHUNK_ROWS)
            yield batch.slice(i, j - i), data[off[i] : off[j]], off[i : j + 1] - off[i]
            i = j


# --- hashing --------------------------------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240917))
_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TABLE_LOWER = _TABLE.copy()
_TABLE_LOWER[65:91] = _TABLE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_POW: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: White space of the word rule: U+0020 and U+0009 to U+000D.
SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POW[0]) < n:
        m = max(n, CHUNK + 1)
        for k, b in enumerate((_BASE, _UNBASE)):
            x = np.full(m, b, np.uint64)
            x[0] = 1
            _POW[k] = np.multiply.accumulate(x)
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray, table: np.ndarray = _TABLE) -> np.ndarray:
    """P with P[i] the hash sum of data[:i]; span_hash() reads any substring's hash from it."""
    n = len(data)
    out = np.empty(n + 1, np.uint64)
    out[0] = 0
    np.cumsum(table[data] * powers(n + 1)[0][:n], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inv = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a chunk: byte spans, document index, 64-bit hash."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = False, hashed: bool = True):
        n = len(data)
        self.n_docs = len(off) - 1
        if not n:
            self.start = self.end = self.doc = np.empty(0, np.int64)
            self.hash = np.empty(0, np.uint64)
        else:
            sep = SEP[data]
            full = np.flatnonzero(off[1:] > off[:-1])
            edge = np.empty(n, bool)
            edge[0], edge[1:] = True, sep[:-1]
            edge[off[:-1][full]] = True
            self.start = np.flatnonzero(edge & ~sep)
            edge[-1], edge[:-1] = True, sep[1:]
            edge[off[1:][full] - 1] = True
            self.end = np.flatnonzero(edge & ~sep) + 1
            self.doc = np.searchsorted(off, self.start, "right") - 1
            if hashed:
                self.hash = span_hash(prefix_hash(data, _TABLE_LOWER if lower else _TABLE), self.start, self.end)
        self.count = np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])  # of each document's words


def grams(h: np.ndarray, k: int, mult: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of the k successive items that start at each position (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    s = np.zeros(n, np.uint64)
    for j in range(k):
        s *= np.uint64(mult)
        s += h[j : j + n]
    return mix(s)


def sort_runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a sorted array: start of each run of equal values, and the run's length."""
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1])
    return at, np.diff(np.append(at, len(x)))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges start[i] .. start[i] + count[i] - 1."""
    total = int(count.sum())
    if not total:
        return np.empty(0, np.int64)
    first = np.cumsum(count) - count
    return np.repeat(start - first, count) + np.arange(total)


def covered(spans_from: np.ndarray, spans_to: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of the positions below n inside any half-open span."""
    d = np.bincount(spans_from, minlength=n + 1).astype(np.int64)[: n + 1]
    d -= np.bincount(spans_to, minlength=n + 1)[: n + 1]
    return np.cumsum(d)[:n] > 0


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


# --- sums of arrays ---------------------------------------------------------------------------

def _adder(key: str, dtype: str):
    def add(t: pa.Table) -> pa.Table:
        total = 0
        for v in t.column("values").to_pylist():
            total = total + np.frombuffer(v, dtype).astype(float)
        return pa.table({key: t.column(key).slice(0, 1), "values": pa.array([total.astype(dtype).tobytes()], pa.binary())})
    return add


def add_slices(parts: DataFrame, dtype: str) -> dict[int, np.ndarray]:
    """Sums of packed arrays (slice int, values binary) by slice, on the driver: for tables of a
    fixed size only. In two steps, so that no task gets an array of every scan partition."""
    step = parts.withColumn("at", F.col("slice") * 64 + F.pmod(F.spark_partition_id(), F.lit(64)))
    step = step.groupBy("at").applyInArrow(_adder("at", dtype), "at int, values binary")
    rows = step.withColumn("slice", F.floor(F.col("at") / 64).cast("int")).groupBy("slice").applyInArrow(
        _adder("slice", dtype), "slice int, values binary").collect()
    return {r["slice"]: np.frombuffer(r["values"], dtype) for r in rows}
