"""Best-fit packing by patterns fitted with non-negative least squares.

Documents are tokenized, closed with END and cut into pieces of at most ROOM tokens (only the first piece of a
document may be shorter). The histogram of piece lengths, at most ROOM numbers whatever the
input, goes to the driver. There all patterns of two or three lengths that fill a sequence
exactly are enumerated; non-negative least squares (accelerated projected gradient) fits how
often each is repeated so that the histogram is used up; the numbers are rounded down to what is there.
What is left is packed best-fit decreasing, on counts instead of documents. The plan says for
each length which ranks go where; ranks within a length are dealt in two levels, so that a
length that many documents share is never in one task.

Cases: null or empty texts are one piece of one token (END); equal lengths and repeated rows are
pieces of their own; empty tables give empty results; extra input columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keymend.llm.common import arrow_batches, chunks, documents, stash
from keymend.llm.tokens import encoder

ROOM = 2048
END = 0
#: Rounds of the least-squares fit, and patterns kept of it; the rest of the histogram is packed best-fit.
ROUNDS = 200
PATTERNS = 20000
#: Pieces of one length that are ranked in one task.
CHUNK = 20000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(path: str, room: int):
    def cut(batches):
        enc = encoder(path)
        for rows, data, off in chunks(batches):
            ids = rows.column("doc_id").to_pylist()
            out = [[], [], [], [], []]
            for doc, tokens in zip(ids, enc.encode(data, off), strict=True):
                t = np.append(tokens, END).astype("<u4")
                head = len(t) % room or room
                begin = 0
                for k in range(-(-len(t) // room)):
                    end = head + k * room
                    for col, v in zip(out, (doc, k, begin, end - begin, zlib.crc32(t[begin:end].tobytes())), strict=True):
                        col.append(v)
                    begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), *(pa.array(c, pa.int64()) for c in out[2:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return cut


def patterns(lengths: np.ndarray, room: int) -> np.ndarray:
    """All (a <= b <= c) of the given lengths, c = 0 for pairs, that fill the room exactly."""
    have = np.zeros(room + 1, bool)
    have[lengths] = True
    out = []
    a = lengths[2 * lengths <= room]
    a = a[have[room - a]]
    out.append(np.stack([a, room - a, np.zeros_like(a)], 1))
    for x in lengths[3 * lengths <= room]:
        y = lengths[(lengths >= x) & (2 * lengths <= room - x)]
        y = y[have[room - x - y]]
        out.append(np.stack([np.full_like(y, x), y, room - x - y], 1))
    return np.concatenate(out)


def fit(shapes: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring sum(x * pattern) near the histogram."""
    x = np.zeros(len(shapes))
    if not len(shapes):
        return x
    scale = hist.max()
    want = hist / scale
    y, t = x, 1.0

    def use(v):
        return sum(np.bincount(shapes[:, k], v, len(want)) * (shapes[0, k] >= 0) for k in range(3))

    touch = np.bincount(shapes.reshape(-1), minlength=len(want)).astype(float)
    touch[0] = 0
    step = 1.0 / (3 * max(touch.max(), 1))
    for _ in range(rounds):
        over = use(y) - want
        over[0] = 0
        grad = over[shapes].sum(1)
        new = np.maximum(y - step * grad, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = np.maximum(new + (t - 1) / t_new * (new - x), 0)
        x, t = new, t_new
    return x * scale


def plan(hist: dict[int, int], room: int = ROOM) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, count, first sequence, offset): pieces of that length and ranks
    from the first on go into successive sequences at that offset; and the number of sequences."""
    left = np.zeros(room + 1, np.int64)
    for length, n in hist.items():
        left[length] = n
    shapes = patterns(np.flatnonzero(left), room)
    x = fit(shapes, left.astype(float))
    order = np.argsort(-x, kind="stable")[:PATTERNS]
    taken = np.zeros(room + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(content: list[int], n: int) -> None:
        nonlocal sequences
        at = 0
        for length in content:
            rows.append((length, int(taken[length]), n, sequences, at))
            taken[length] += n
            at += length
        sequences += n

    for i in order[x[order] >= 0.5]:
        content = [int(v) for v in shapes[i] if v]
        n = min(int(left[v]) // content.count(v) for v in content)
        n = min(n, int(round(x[i])))
        if n > 0:
            for v in content:
                left[v] -= n
            put(content, n)
    # best fit, decreasing, of the residual: open[space] holds [content, number of sequences]
    open_: list[list[list]] = [[] for _ in range(room + 1)]
    for length in range(room, 0, -1):
        n = int(left[length])
        space = length
        while n and space < room:
            if not open_[space]:
                space += 1
                continue
            group = open_[space][-1]
            k = min(n, group[1])
            open_[space - length].append([[*group[0], length], k])
            group[1] -= k
            if not group[1]:
                open_[space].pop()
            n -= k
        if n:
            fits = room // length
            if n >= fits:
                open_[room - fits * length].append([[length] * fits, n // fits])
            if n % fits:
                open_[room - n % fits * length].append([[length] * (n % fits), 1])
    for groups in open_:
        for content, n in groups:
            put(content, n)
    return np.array(rows, np.int64).reshape(-1, 5), sequences


def _placed(table: np.ndarray):
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    key = (table[:, 0] << 44) + table[:, 1]

    def place(batches):
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
            length, rank = (col[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = table[np.searchsorted(key, (length << 44) + rank, "right") - 1] if len(rank) else np.empty((0, 5), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(col[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


def pack(docs: DataFrame, path: str | None = None, room: int = ROOM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    pieces = "doc_id long, piece int, start long, length long, ids_crc32 long"
    rows = stash(docs.select("doc_id", "text").mapInArrow(_pieces(path or tokenizer_path(), room), pieces), "pieces")
    hist = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `room` rows
    table, _ = plan(hist, room)
    # ranks within a length, in two levels
    sizes = F.broadcast(spark.createDataFrame([(k, -(-n // CHUNK)) for k, n in hist.items()], "length long, parts long"))
    dealt = rows.join(sizes, "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "parts")).drop("parts")
    dealt = stash(dealt, "dealt")
    sums = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start")
    ranked = dealt.withColumn("rn", F.row_number().over(inside)).join(sums, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("rn") - 1).drop("base", "rn", "part")
    return ranked.mapInArrow(_placed(table), pieces + ", sequence_id long, offset long")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
