"""Quality classifier: random-indexing word vectors pooled per document, two-layer network,
temperature-calibrated probabilities.

1. Random indexing: every word (lower case) and every word shape (runs of upper case, lower case, digits and
   punctuation) has a fixed sparse random vector. The context vector of a word or shape is the sum of its
   neighbours' random vectors over all documents, a vector of its own for each (47 bits of a hash tell words apart:
   of 100 million, about 35 pairs share one). Texts form blocks; each block sends the sums of its
   distinct words and shapes to buckets by hash, which add up and answer with the directions, in fifteen levels a
   number. So the table grows with the vocabulary, and no task or machine holds it whole.
2. A document's features are the mean normalised context vectors of its words and of its shapes,
   and the logarithm of its length. Texts are read whole, and once more for this: a block's second reading gives
   each document's distinct items and their times, which meet the answers.
3. The network (features -> HIDDEN -> 1) learns on the driver from at most SAMPLE labelled rows (those with
   the smallest hash of doc_id) outside the held-out third; a fifth of them only
   sets the temperature that the logits are divided by.

Cases: null or empty texts have zero features and get the score of these; labels that are null or
of unknown documents teach nothing, of several labels of a document the largest counts; without
both classes every score is the share of label 1 (0.5 without labels); repeated rows each get a row; empty tables
give empty results; extra input columns are ignored, and lang, source and doc_id are no features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import Words, arrow_batches, chunks, documents, id_array, ids_back, mix, n_buckets, prefix_hash, span_hash, stash

DIM = 32
SAMPLE = 20000
HIDDEN = 32
EPOCHS = 60
#: Words gathered before a block is closed, and items of documents whose vectors are pooled at once.
BLOCK_TOKENS = 3_000_000
POOL_ITEMS = 200_000

_SHAPE = np.arange(256) % 128 + 3
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 0, 1, 2, 1


def _tokens(data: np.ndarray, off: np.ndarray):
    """Words of a chunk with the key of each word and of its shape: 48 bits, even for words and odd for shapes."""
    w = Words(data, off, lower=True)
    if not len(w.start):
        return w, np.empty(0, np.uint64), np.empty(0, np.uint64)
    kind = _SHAPE[data].astype(np.uint8)
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[w.start] = True
    run = np.concatenate([[0], np.cumsum(new)])
    shape = span_hash(prefix_hash(kind[new]), run[w.start], run[w.end])
    word = mix(w.hash ^ np.uint64(0xA5A5A5A5)) >> np.uint64(16)
    return w, word & ~np.uint64(1), shape >> np.uint64(16) | np.uint64(1)


def _zip(x: np.ndarray, width: int) -> bytes:
    """Numbers that are not negative and fit `width` bytes, as byte planes, compressed."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unzip(b: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def _pack_sums(x: np.ndarray) -> tuple[bytes, bytes]:
    """Integer vectors as a bit mask of their nonzero numbers and these numbers."""
    full = x != 0
    v = x[full].astype(np.int64)
    return _zip(np.packbits(full, axis=1).reshape(-1), 1), _zip((v << 1) ^ (v >> 63), 4)


def _unpack_sums(mask: bytes, values: bytes) -> np.ndarray:
    full = np.unpackbits(_unzip(mask, 1).astype(np.uint8).reshape(-1, DIM // 8), axis=1).astype(bool)
    v = _unzip(values, 4)
    out = np.zeros(full.shape, np.int64)
    out[full] = (v >> np.uint64(1)).astype(np.int64) ^ -(v & np.uint64(1)).astype(np.int64)
    return out


def _pack_directions(x: np.ndarray) -> bytes:
    """The directions of vectors, in fifteen levels up to the largest number of each."""
    top = np.maximum(np.abs(x).max(axis=1, keepdims=True), 1) if len(x) else 1
    q = (np.rint(x * (7 / top)) + 8).astype(np.uint8)
    return _zip((q[:, ::2] << 4 | q[:, 1::2]).reshape(-1), 1)


def _unpack_directions(b: bytes) -> np.ndarray:
    """Vectors of length 1 (0 for items without neighbours)."""
    q = _unzip(b, 1).astype(np.uint8).reshape(-1, DIM // 2)
    x = np.empty((len(q), DIM), np.float32)
    x[:, ::2], x[:, 1::2] = q >> 4, q & 15
    x -= 8
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _sums(keys: np.ndarray, number: np.ndarray, together: np.ndarray) -> np.ndarray:
    """Context sums of the items with these keys, which stand in a row as `number`."""
    table = np.zeros(len(keys) * DIM)
    for nonzero in range(2):
        v = mix(keys + np.uint64(nonzero + 1))
        dim, sign = (v % np.uint64(DIM)).astype(np.int64)[number], np.where(v >> np.uint64(63), 1.0, -1.0)[number]
        for to, of in ((slice(None, -1), slice(1, None)), (slice(1, None), slice(None, -1))):
            if len(number) > 1:
                table += np.bincount(number[to] * DIM + dim[of], sign[of] * together, len(table))
    return table.reshape(-1, DIM).astype(np.int32)


_MESSAGE = pa.schema({"bucket": pa.int32(), "block": pa.int64(), "keys": pa.binary(), "mask": pa.binary(), "sums": pa.binary()})
_TEXTS = pa.schema({"block": pa.int64(), "bucket": pa.int32(), "ids": pa.binary(), "size": pa.binary(), "items": pa.binary(), "item": pa.binary(), "times": pa.binary(), "shapes": pa.binary()})
_ANSWER = pa.schema({"block": pa.int64(), "bucket": pa.int32(), "vectors": pa.binary()})


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class _Block:
    def __init__(self):
        self.ids, self.size, self.items, self.n = [], [], ([], []), 0

    def add(self, rows, w: Words, *items: np.ndarray):
        self.ids.append(id_array(rows.column("doc_id")))
        self.size.append(w.count)
        for kept, x in zip(self.items, items, strict=True):
            kept.append(x)
        self.n += len(items[0]) + w.n_docs

    def rows(self, part: int, seq: int, buckets: int, texts: bool) -> pa.RecordBatch:
        """The block's texts, or its messages to buckets. Distinct items are numbered by bucket, then key."""
        ids, size = np.concatenate(self.ids), np.concatenate(self.size)
        found = [np.unique(np.concatenate(x), return_inverse=True) for x in self.items]
        self.items = ()
        keys = np.concatenate([u for u, _ in found])
        block = int(mix(np.array([np.bitwise_xor.reduce(keys, initial=0) ^ np.uint64((part << 24) + seq)], np.uint64))[0] >> np.uint64(1))
        to = ((keys >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((keys, to))
        doc = np.repeat(np.arange(len(size)), size)
        if texts:
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            spot = np.concatenate([doc * len(keys) + place[: len(found[0][0])][found[0][1]], doc * len(keys) + place[len(found[0][0]) :][found[1][1]]])
            spot, times = np.unique(spot, return_counts=True)
            of, item = np.divmod(spot, max(len(keys), 1))
            step = item.copy()
            step[1:] -= np.where(of[1:] == of[:-1], item[:-1], 0)
            row = (block, -1, ids.astype("<i8").tobytes(), _zip(size, 8), _zip(np.bincount(of, minlength=len(size)), 8),
                   _zip(step, 4), _zip(times, 4), np.packbits((keys[order] & np.uint64(1)).astype(bool)).tobytes())
            return pa.RecordBatch.from_pylist([dict(zip(_TEXTS.names, row, strict=True))], _TEXTS)
        together = (doc[1:] == doc[:-1]).astype(float)
        sums = np.concatenate([_sums(u, number, together) for u, number in found])
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(cuts)):
            mine = order[cuts[b] : cuts[b + 1]]
            out.append(dict(zip(_MESSAGE.names, (int(b), block, _zip(np.diff(keys[mine], prepend=np.uint64(0)), 6), *_pack_sums(sums[mine])), strict=True)))
        return pa.RecordBatch.from_pylist(out, _MESSAGE)


def _blocks(buckets: int, texts: bool):
    def cut(batches):
        block, seq = _Block(), 0
        part = TaskContext.get().partitionId()
        for rows, data, off in chunks(batches):
            block.add(rows, *_tokens(data, off))
            if block.n >= BLOCK_TOKENS:
                yield block.rows(part, seq, buckets, texts)
                block, seq = _Block(), seq + 1
        if block.ids:
            yield block.rows(part, seq, buckets, texts)
    return cut


def _add_up(t: pa.Table) -> pa.Table:
    """A bucket's answers: the direction of the sum over all blocks of each item of each message."""
    block, keys, masks, values = (t.column(c).to_pylist() for c in ("block", "keys", "mask", "sums"))
    keys = [np.cumsum(_unzip(k, 6)) for k in keys]
    unique, which = np.unique(np.concatenate(keys), return_inverse=True)
    which = np.split(which, np.cumsum([len(k) for k in keys])[:-1])
    total = np.zeros((len(unique), DIM), np.int64)
    for at, m, v in zip(which, masks, values, strict=True):
        total[at] += _unpack_sums(m, v)  # a message has an item once
    return pa.Table.from_arrays(
        [pa.array(block, pa.int64()), t.column("bucket").combine_chunks(), pa.array([_pack_directions(total[at]) for at in which], pa.binary())], schema=_ANSWER)


def _pool(t: pa.Table) -> pa.Table:
    """A block's features from its texts and the answers."""
    bucket = t.column("bucket").to_pylist()
    if bucket.count(-1) != 1:
        raise RuntimeError("the documents were not read in the same blocks twice; write them as a table first")
    head = t.slice(bucket.index(-1), 1).to_pylist()[0]
    answers = [v for b, v in sorted(zip(bucket, t.column("vectors").to_pylist(), strict=True), key=lambda x: x[0]) if b >= 0]
    vectors = np.concatenate([_unpack_directions(v) for v in answers] + [np.empty((0, DIM), np.float32)])
    ids, size, items = np.frombuffer(head["ids"], "<i8"), _unzip(head["size"], 8).astype(np.int64), _unzip(head["items"], 8).astype(np.int64)
    shape = np.unpackbits(np.frombuffer(head["shapes"], np.uint8), count=len(vectors)).astype(bool)
    step, times = _unzip(head["item"], 4).astype(np.int64), _unzip(head["times"], 4).astype(np.float32)
    run = np.cumsum(step)
    first = np.cumsum(items) - items
    item = run - np.repeat(np.concatenate([[0], run])[first], items)
    doc = np.repeat(np.arange(len(size)), items)
    out = np.zeros((len(size), 2 * DIM + 1), np.float64)
    for i in range(0, len(doc), POOL_ITEMS):
        for k in range(2):
            at = i + np.flatnonzero(shape[item[i : i + POOL_ITEMS]] == k)
            first = np.flatnonzero(np.diff(doc[at], prepend=-1))
            if len(at):
                out[doc[at[first]], k * DIM : (k + 1) * DIM] += np.add.reduceat(vectors[item[at]] * times[at, None], first, axis=0)
    out[:, :-1] /= np.maximum(size, 1)[:, None]
    out[:, -1] = np.log1p(size)
    return pa.table({"doc_id": ids_back(ids), "features": pa.array([r.tobytes() for r in out.astype("<f4")], pa.binary())})


def pooled(docs: DataFrame) -> DataFrame:
    """doc_id and packed features of every row of `docs` (doc_id, text). `docs` is read twice, in the same partitions
    and order (a table, not the end of a shuffle), or the job stops: texts needn't be kept while vectors are summed."""
    docs = docs.select("doc_id", "text")
    buckets = n_buckets(docs)
    answers = docs.mapInArrow(_blocks(buckets, False), _ddl(_MESSAGE)).groupBy("bucket").applyInArrow(_add_up, _ddl(_ANSWER))
    mail = docs.mapInArrow(_blocks(buckets, True), _ddl(_TEXTS)).unionByName(answers, allowMissingColumns=True)
    return mail.groupBy("block").applyInArrow(_pool, "doc_id long, features binary")


class Network:
    """Two layers: relu(x a + b) c + d, with standardised inputs and a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 0):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(x))
        cut = max(1, len(x) // 5)
        hold, learn = order[:cut], order[cut:]
        p = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for _ in range(EPOCHS):
            for at in np.array_split(rng.permutation(learn), max(1, len(learn) // 128)):
                h = x[at] @ p[0] + p[1]
                r = np.maximum(h, 0)
                e = (1 / (1 + np.exp(-np.clip(r @ p[2] + p[3], -30, 30))) - y[at]) / len(at)
                back = np.outer(e, p[2]) * (h > 0)
                grads = [x[at].T @ back + 1e-4 * p[0], back.sum(0), r.T @ e + 1e-4 * p[2], e.sum()]
                t += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
        self.p = p
        z = self._logit(x[hold])
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, np.where(y[hold] > 0, -z, z) / g).mean() for g in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _logit(self, x):
        return np.maximum(x @ self.p[0] + self.p[1], 0) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = self._logit((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col), "<f4").reshape(-1, 2 * DIM + 1).astype(float)


def _scores(net: Network):
    def score(batches):
        for b in batches:
            if b.num_rows:
                s = net.score(_matrix(b.column(b.schema.get_field_index("features")).to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(s)], ["doc_id", "score"])
    return score


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1


def _sample(rows: DataFrame, n: int) -> list:
    """At most `n` of `rows`, those with the smallest hash of doc_id. The share of the hashes that is let through to
    the driver holds `n` rows and four standard deviations, so about that many are sent at any size of the table."""
    h = F.shiftrightunsigned(F.xxhash64("doc_id"), 1)
    rows = stash(rows.withColumn("h", h), "labelled")
    share = (n + 4 * n**0.5 + 16) / max(rows.count(), 1)
    found = rows if share >= 1 else rows.filter(F.col("h") < int(share * 2**63))
    return sorted(found.collect(), key=lambda r: (r["h"], r["doc_id"]))[:n]


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    rows = stash(pooled(docs), "features")
    known = labels.filter("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    train = _sample(rows.filter(~held_out()).join(known, "doc_id"), sample)
    x = _matrix([r["features"] for r in train]) if train else np.empty((0, 2 * DIM + 1))
    net = Network(x, np.array([float(r["quality"]) for r in train]))
    scored = rows.mapInArrow(_scores(net), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
