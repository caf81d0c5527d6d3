"""Quality rules: simple counts, then the divergence of a document's histograms from its language.

Counts (whole texts): words, code points in words, symbol characters, repeated lines, words in
repeated 3-word windows. A document fails the base rules when it has under MIN_WORDS words or
when over half of its words are in repeated windows.

Method: every document has a histogram over eight character classes and one over the common
words of four languages (and "other"). Summing the histograms of all documents that pass the
base rules gives one reference per value of `lang`. A document is rejected when its
Jensen-Shannon distance (square root of the divergence in bits) from its reference is over the
limit and its text is long enough for the histogram to mean something; a reference must also
rest on MIN_REFERENCE words, or else it is not used.

Cases: null or empty text has no words and fails the base rules; null `lang` is a language of
its own; ties do not arise; repeated rows each get a row; empty tables give empty results;
extra input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import (
    SEP, Words, arrow_batches, attach, chunks, documents, grams, mix, prefix_hash, sort_runs,
    span_hash, stash,
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Limits of the two distances as (a, b) of a + b / sqrt(n_words), since a short text's histogram
#: strays further by chance; and the least words for the distances to be looked at.
MAX_CHAR_DISTANCE = (0.20, 0.6)
MAX_WORD_DISTANCE = (0.25, 0.9)
GUARD_WORDS = 100
MIN_REFERENCE = 1000

# Common words of English, German, French and Spanish, lower case.
COMMON = (
    "the of and to in is that it was for as with by on are this be at from or an have not they which "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es werden aus er hat dass "
    "le la les et est un une du dans que qui pour pas sur au plus par avec ce il sont ne se en "
    "el los las y de una por con para del se lo su al como más pero sus ha este si o sin sobre"
).split()
_WORDS = sorted(set(COMMON))
BINS = len(_WORDS) + 1
CLASSES = 8


def _class_table() -> np.ndarray:
    """Byte classes: 0 lower, 1 upper, 2 digit, 3 white space, 4 symbol, 5 other ASCII,
    6 first byte of a non-ASCII character, 7 later bytes (not counted)."""
    t = np.full(256, 5, np.int64)
    t[97:123], t[65:91], t[48:58] = 0, 1, 2
    t[np.flatnonzero(SEP)] = 3
    t[list(b"#*$%&|<>")] = 4
    t[192:], t[128:192] = 6, 7
    return t


_CLASS = _class_table()


def _word_bins() -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(" ".join(_WORDS).encode(), np.uint8)
    h = Words(data, np.array([0, len(data)]), lower=True).hash
    order = np.argsort(h)
    return h[order], order


def measure(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """Counts and histograms of each document of a chunk."""
    n, w = len(off) - 1, Words(data, off, lower=True)
    doc_of = np.repeat(np.arange(n), np.diff(off))
    chars = np.bincount(doc_of * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES)
    prefix = prefix_hash(data)
    # lines that have a word, by their hash within the document
    cut = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([off[:-1][off[1:] > off[:-1]], cut + 1]))
    start = np.unique(start[start < len(data)])
    line_doc = np.searchsorted(off, start, "right") - 1
    after = np.append(start[1:], len(data))
    end = np.minimum(after, off[1:][line_doc]) if n else after
    end = end - ((end > start) & (data[np.maximum(end - 1, 0)] == 10))
    words_before = np.searchsorted(w.start, np.stack([start, end]))
    has = words_before[1] > words_before[0]
    key = mix(span_hash(prefix, start[has], end[has]) ^ mix(line_doc[has].astype(np.uint64)))
    order = np.argsort(key)
    key, owner = key[order], line_doc[has][order]
    again = np.concatenate([[False], key[1:] == key[:-1]]) if len(key) else np.empty(0, bool)
    dup_lines = np.bincount(owner[again], minlength=n)
    # words in 3-word windows that occur twice or more in the document
    exact = span_hash(prefix, w.start, w.end)
    g = grams(exact, 3)
    ok = np.flatnonzero(w.doc[2:] == w.doc[:-2]) if len(g) else np.empty(0, np.int64)
    k = mix(g[ok] ^ mix(w.doc[ok].astype(np.uint64)))
    order = np.argsort(k)
    at, length = sort_runs(k[order])
    seen = np.repeat(length, length) > 1
    hit = ok[order[seen]]
    cover = np.zeros(len(w.start) + 2, bool)
    for d in range(3):
        cover[hit + d] = True
    repeat = np.bincount(w.doc[cover[: len(w.start)]], minlength=n)
    # common words
    known, which = _word_bins()
    pos = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
    bin_ = np.where(known[pos] == w.hash, which[pos], BINS - 1)
    words = np.bincount(w.doc * BINS + bin_, minlength=n * BINS).reshape(n, BINS)
    lead = (data & 0xC0) != 0x80
    return {
        "n_words": w.count, "word_chars": np.bincount(doc_of[lead & ~SEP[data]], minlength=n),
        "n_symbols": chars[:, 4], "n_dup_lines": dup_lines, "n_repeat_words": repeat,
        "chars": chars[:, : CLASSES - 1], "words": words,
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1).astype(np.int32)))


def _measured(batches):
    for rows, data, off in chunks(batches):
        m = measure(data, off)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("lang"), *(pa.array(m[c].astype(np.int64)) for c in _COUNTS),
             _lists(m["chars"]), _lists(m["words"])],
            ["doc_id", "lang", *_COUNTS, "chars", "words"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of two count tables; 0 where either row is empty."""
    sp, sq = p.sum(1, keepdims=True), q.sum(1, keepdims=True)
    p, q = p / np.maximum(sp, 1), q / np.maximum(sq, 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = (np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)).sum(1) / 2
    return np.where((sp[:, 0] > 0) & (sq[:, 0] > 0), np.sqrt(np.clip(d, 0, 1)), 0.0)


def _matrix(col, width: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width).astype(float)


def _judged(batches):
    for b in batches:
        if not b.num_rows:
            continue
        col = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
        words, repeat = col["n_words"].to_numpy(), col["n_repeat_words"].to_numpy()
        failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
        jc = js_distance(_matrix(col["chars"], CLASSES - 1), _matrix(col["ref_chars"], CLASSES - 1))
        ref = _matrix(col["ref_words"], BINS)
        jw = js_distance(_matrix(col["words"], BINS), ref)
        look = (words >= GUARD_WORDS) & (ref.sum(1) >= MIN_REFERENCE)
        root = np.sqrt(np.maximum(words, 1))
        (ac, bc), (aw, bw) = MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE
        bad = look & ((jc > ac + bc / root) | (jw > aw + bw / root))
        yield pa.RecordBatch.from_arrays(
            [col["doc_id"], *(col[c] for c in _COUNTS), pa.array(failed), pa.array(~failed & ~bad), pa.array(jc), pa.array(jw)],
            ["doc_id", *_COUNTS, "base_failed", "kept", "char_distance", "word_distance"])


_SUM_SCHEMA = f"lang_key string, k int, v long"
_OUT = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean, char_distance double, word_distance double"


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, base verdict, distances and verdict for every row of `docs` (doc_id, text, lang)."""
    arrow_batches(docs.sparkSession)
    fields = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", chars array<int>, words array<int>"
    rows = stash(docs.select("doc_id", "text", "lang").mapInArrow(_measured, fields)
                 .withColumn("lang", F.coalesce("lang", F.lit("\0"))), "counts")
    passed = rows.filter((F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words")))
    sums = [F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(CLASSES - 1)]
    sums += [F.sum(F.col("words")[i]).alias(f"w{i}") for i in range(BINS)]
    refs = passed.groupBy("lang").agg(*sums).select(
        "lang", F.array(*(f"c{i}" for i in range(CLASSES - 1))).alias("ref_chars"),
        F.array(*(f"w{i}" for i in range(BINS))).alias("ref_words"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("cnt"))
    zeros = [F.coalesce(c, F.array_repeat(F.lit(0).cast("long"), n)).alias(c) for c, n in (("ref_chars", CLASSES - 1), ("ref_words", BINS))]
    refs = stash(sizes.join(refs, "lang", "left").select("lang", "cnt", *zeros), "references")
    return attach(rows, refs, "lang", rows.count()).mapInArrow(_judged, _OUT)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
