"""Substring dedup over words with difference-cover anchors.

A removed word lies in a window of WINDOW words that also starts earlier. Positions are taken
modulo PERIOD; COVER is a difference cover of it, so for any two positions i, j there is a shift
d < PERIOD with both i + d and j + d in the cover. Two equal windows therefore share an anchor
(ANCHOR words, WINDOW = PERIOD - 1 + ANCHOR) at the same shift. So

1. anchors at cover positions alone (4 of 13) are hashed and matched over all documents;
2. around matched anchors every window that holds one is hashed with 96 bits and matched for its
   first start: this extends an anchor to all windows it can belong to;
3. the words that repeated windows cover are cut.

Documents whose whole word sequence equals an earlier one's need no windows: they go whole (or
stay whole when shorter than a window). Only digests are kept of documents without matches.

Cases: null, empty and short texts (under 20 words) keep everything; rows that repeat a doc_id
count as one document and get the same verdict each; a row with a null
doc_id keeps everything and takes nothing from other documents: its windows are not matched; empty tables give empty results; extra
input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import Words, arrow_batches, attach, chunks, covered, documents, grams, id_array, mix, stash
from keymend.llm.exchange import find_repeats

WINDOW = 20
PERIOD = 13
#: Difference cover modulo 13: every residue is a difference of two of these.
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_EMPTY = hashlib.sha256(b"").hexdigest()


def _digests(batches):
    for rows, data, off in chunks(batches):
        raw = data.tobytes()
        n, sha = [], []
        for a, b in zip(off[:-1], off[1:], strict=True):
            w = raw[a:b].split()  # bytes.split() knows just the rule's white space
            n.append(len(w))
            sha.append(hashlib.sha256(b" ".join(w)).hexdigest())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha)], ["doc_id", "n_words", "sha"])


def _ids(rows: pa.RecordBatch) -> np.ndarray:
    return id_array(rows.column("doc_id"))


def _anchors(rows, data, off):
    w = Words(data, off)
    pos = np.arange(len(w.start)) - w.first[w.doc]
    ok = _IN_COVER[pos % PERIOD] & (pos + ANCHOR <= w.count[w.doc])
    at = np.flatnonzero(ok)
    g = grams(w.hash, ANCHOR)
    return _ids(rows), w.count, w.doc[at], pos[at], g[at], None


def _unpack(col) -> tuple[np.ndarray, np.ndarray]:
    """All uint32 values of a column of packed arrays, and the row of each."""
    parts = [np.frombuffer(x or b"", "<u4").astype(np.int64) for x in col.to_pylist()]
    return np.concatenate([*parts, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _windows(rows, data, off):
    w = Words(data, off)
    hit, doc = _unpack(rows.column("hits"))
    low = np.maximum(hit - (WINDOW - ANCHOR), 0)
    high = np.minimum(hit, w.count[doc] - WINDOW) + 1
    good = high > low
    first = w.first[doc[good]]
    at = np.flatnonzero(covered(first + low[good], first + high[good], len(w.start)))
    g = grams(w.hash, WINDOW)
    h = grams(mix(w.hash ^ np.uint64(0x5851F42D4C957F2D)), WINDOW, 0xA0761D6478BD642F)
    return _ids(rows), w.count, w.doc[at], at - w.first[w.doc[at]], g[at], (h[at] >> np.uint64(32)).astype(np.uint32)


def _cut(batches):
    for rows, data, off in chunks(batches):
        w = Words(data, off, hashed=False)
        hit, doc = _unpack(rows.column("hits"))
        a = w.first[doc] + hit
        gone = covered(a, a + WINDOW, len(w.start))
        removed = np.bincount(w.doc[gone], minlength=w.n_docs)
        raw = data.tobytes()
        sha = []
        for d in range(w.n_docs):
            span = slice(w.first[d], w.first[d + 1])
            keep = ~gone[span]
            sha.append(hashlib.sha256(b" ".join(raw[i:j] for i, j in zip(w.start[span][keep], w.end[span][keep], strict=True))).hexdigest())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(removed.astype(np.int64)), pa.array(sha)], ["doc_id", "cut", "cut_sha"])


def repeated_windows(docs: DataFrame, originals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For the documents named in `originals` (doc_id): doc_id and packed starts of the windows
    that also start earlier; and doc_id, text of the documents with matched anchors."""
    texts = docs.select("doc_id", "text")
    anchors = find_repeats(texts, _anchors, later=False, key_bytes=5)
    near = stash(texts.join(anchors.join(originals, "doc_id", "left_semi"), "doc_id"), "matched-texts")
    return find_repeats(near, _windows, later=True), near.drop("hits")


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of `docs` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    base = stash(docs.select("doc_id", "text").mapInArrow(_digests, "doc_id long, n_words long, sha string"), "word-digests")
    firsts = stash(base.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("cnt")), "word-copies")
    windows, texts = repeated_windows(docs, firsts.select(F.col("first_id").alias("doc_id")))
    cuts = texts.join(windows, "doc_id").mapInArrow(_cut, "doc_id long, cut long, cut_sha string").dropDuplicates(["doc_id"])
    rows = attach(base, firsts, "sha", base.count()).join(cuts, "doc_id", "left")
    copy = (F.col("doc_id") != F.col("first_id")) & (F.col("n_words") >= WINDOW)
    return rows.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.lit(_EMPTY)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir))
