"""Suffix-array dedup over bytes: cut every byte that a LENGTH-byte string covers which also
starts anywhere else.

One suffix array over all text would not fit any machine, so equal strings are first led to the
same task. The LENGTH-byte string at a start is represented by the smallest hash of its GRAM-byte
substrings: equal strings have equal representatives. Successive starts with the same representative form
a region (about 190 starts in plain prose). A representative found in one place only belongs
to no repeat and is dropped. The regions of the others are gathered by representative; identical regions
count as one; and where different regions remain, their text is sorted by the two-stage method
(`suffix_sort`) and adjacent suffixes with a common prefix of LENGTH bytes are repeats.

Copies of a whole document are settled by digest: of LENGTH bytes or more, all bytes go.
A representative with over HOT_REGIONS regions (a passage in a large share of all documents) is not gathered:
its strings are matched by `exchange.find_repeats`, where a block sends each string once and 96 bits of two
hashes decide. Regions with one representative count as identical by 64 more bits over all their bytes.

Cases: null and empty texts have no bytes and keep the empty digest; texts under LENGTH bytes
stay whole; rows that repeat a doc_id and text count as one document, not as copies;
rows with a null doc_id are documents like others, known by a hash of their text, so that equal texts
without a doc_id count as one document; empty
tables give empty results; extra input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import (
    arrow_batches, attach, chunks, covered, documents, id_array, mix, n_parts, prefix_hash, ragged, sort_runs,
    span_hash, stash,
)
from keymend.llm.exchange import find_repeats
from keymend.llm.suffix_sort import adjacent_prefix_at_least, suffix_array

LENGTH = 400
GRAM = 32
#: More regions than this of one representative are matched in blocks instead of in one task.
HOT_REGIONS = 4000
#: Text of regions sorted at once.
SORT_BYTES = 3 << 20

_SPAN = LENGTH - GRAM + 1  # grams of a string
_FIRST_BITS = 20
_EMPTY = hashlib.sha256(b"").hexdigest()


def _among(h: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Where in `h` a hash of `some` stands. A table of their first bits leaves out nearly all other places, so that
    `h` isn't sorted."""
    if not len(some):
        return np.empty(0, np.int64)
    some, cut = np.unique(some), np.uint64(64 - _FIRST_BITS)
    seen = np.zeros(1 << _FIRST_BITS, bool)
    seen[some >> cut] = True
    at = np.flatnonzero(seen[h >> cut])
    which = np.minimum(np.searchsorted(some, h[at]), len(some) - 1)
    return at[some[which] == h[at]]


def regions(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a chunk: document, first start, number of starts, representative, and number of
    places of the representative, of each region."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none
    p = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    h = span_hash(p, at, at + GRAM)
    # sliding minimum over _SPAN grams, by prefix and suffix minima of blocks
    n = len(h) - _SPAN + 1
    rows = -(-len(h) // _SPAN)
    g = np.full(rows * _SPAN, np.iinfo(np.uint64).max, np.uint64)
    g[: len(h)] = h
    g = g.reshape(rows, _SPAN)
    ahead = np.minimum.accumulate(g, axis=1).reshape(-1)
    back = np.minimum.accumulate(g[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    low = np.minimum(back[:n], ahead[_SPAN - 1 : _SPAN - 1 + n])
    size = np.diff(off)
    full = np.flatnonzero(size >= LENGTH)
    start = ragged(off[:-1][full], size[full] - LENGTH + 1)
    doc = np.repeat(full, size[full] - LENGTH + 1)
    value = low[start]
    new = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    begin, rep = start[first], value[first]
    # places of the representative inside each region
    held = _among(h, rep)
    key = h[held]
    order = np.lexsort((held, key))
    held, key = held[order], key[order]
    at, length = sort_runs(key)
    which = np.searchsorted(key[at], rep)
    lo, hi = at[which], at[which] + length[which]
    # positions are sorted within a key: count those in [begin, begin + count + _SPAN - 1)
    rank = (np.repeat(np.arange(len(at)), length).astype(np.int64) * (len(h) + 1)) + held
    a = np.searchsorted(rank, which * (len(h) + 1) + begin)
    b = np.searchsorted(rank, which * (len(h) + 1) + begin + count + _SPAN - 1)
    places = np.minimum(b, hi) - np.maximum(a, lo)
    return doc[first], begin - off[:-1][doc[first]], count, rep.view(np.int64), places


def _scan(batches):
    for rows, data, off in chunks(batches):
        raw, n = data.tobytes(), len(off) - 1
        sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
        doc, start, count, rep, places = regions(data, off)
        cut = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (
            start.astype(np.int32), count.astype(np.int32), rep, places.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("nameless"), pa.array(np.diff(off)), pa.array(sha), *lists],
            ["doc_id", "nameless", "n_bytes", "sha", "start", "count", "rep", "places"])


_SCAN = "doc_id long, nameless boolean, n_bytes long, sha string, start array<int>, count array<int>, rep array<long>, places array<int>"


def _spread(rows: pa.RecordBatch):
    """start, count, rep of the row's regions, with the row of each."""
    col = rows.column("regions")
    flat = col.flatten()
    doc = np.repeat(np.arange(len(col)), np.diff(np.asarray(col.offsets)))
    return doc, *(flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "count", "rep"))


def _texts(batches):
    """One row a region; its text only where this chunk has not given it already."""
    for rows, data, off in chunks(batches):
        doc, start, count, rep = _spread(rows)
        ids = id_array(rows.column("doc_id"))
        a = off[:-1][doc] + start
        b = a + count + LENGTH - 1
        body = span_hash(prefix_hash(data), a, b)
        _, first = np.unique(body, return_index=True)
        give = np.zeros(len(a), bool)
        give[first] = True
        raw = data.tobytes()
        text = [raw[i:j] if g else None for i, j, g in zip(a, b, give, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep), pa.array(body.view(np.int64)), pa.array(ids[doc]), pa.array(start.astype(np.int32)),
             pa.array(count.astype(np.int32)), pa.array(text, pa.binary())],
            ["rep", "body", "doc_id", "start", "count", "text"])


_REGION = "rep long, body long, doc_id long, start int, count int, text binary"


def repeated_starts(texts: list[bytes], counts: list[int]) -> list[np.ndarray]:
    """For each region (text of count + LENGTH - 1 bytes): which of its starts have an equal
    string at another start of any region."""
    size = np.array([len(t) + 1 for t in texts])
    base = np.cumsum(size) - size
    text = np.zeros(int(size.sum()), np.uint8)
    flat = np.frombuffer(b"\xff".join(texts) + b"\xff", np.uint8)
    text[:] = np.where(flat == 255, 0, flat + 1)  # 255 is in no UTF-8 text
    sa = suffix_array(text, LENGTH)
    starts = np.zeros(len(text), bool)
    starts[ragged(base, np.array(counts))] = True
    order = sa[starts[sa]]
    equal = adjacent_prefix_at_least(text, order, LENGTH)
    hit = np.zeros(len(text), bool)
    hit[order[:-1][equal]] = hit[order[1:][equal]] = True
    return [hit[b : b + c] for b, c in zip(base, counts, strict=True)]


def _runs(hit: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    d = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    return np.flatnonzero(d == 1) + start, np.flatnonzero(d == -1) + start + LENGTH - 1


def _decide(groups: list[dict]) -> pa.RecordBatch | None:
    """Groups of regions by representative: which of their starts are repeats."""
    texts, counts, back = [], [], []
    verdict: dict[tuple[int, int], np.ndarray | None] = {}
    for g, bodies in enumerate(groups):
        for b, members in bodies["of"].items():
            if len(members) > 1:
                verdict[g, b] = None  # the whole region stands elsewhere too
        if len(bodies["of"]) > 1 or any(c > 1 for c in bodies["count"].values()):
            for b in bodies["of"]:
                texts.append(bodies["text"][b])
                counts.append(bodies["count"][b])
                back.append((g, b))
    if texts:
        for k, hit in zip(back, repeated_starts(texts, counts), strict=True):
            verdict.setdefault(k, hit)
    ids, low, high = [], [], []
    for (g, b), hit in verdict.items():
        whole = hit is None
        if whole or hit.any():
            for doc, start in groups[g]["of"][b]:
                x, y = _runs(np.ones(groups[g]["count"][b], bool) if whole else hit, start)
                ids += [doc] * len(x)
                low.append(x)
                high.append(y)
    if not ids:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.concatenate(low).astype(np.int32)), pa.array(np.concatenate(high).astype(np.int32))],
        ["doc_id", "low", "high"])


def _sorted_regions(batches):
    """Rows come sorted by representative; whole groups are gathered up to SORT_BYTES."""
    groups: list[dict] = []
    last, held = None, 0
    for batch in batches:
        col = [batch.column(c).to_pylist() for c in ("rep", "body", "doc_id", "start", "count", "text")]
        for rep, body, doc, start, count, text in zip(*col, strict=True):
            if rep != last:
                if held >= SORT_BYTES:
                    if (out := _decide(groups)) is not None:
                        yield out
                    groups, held = [], 0
                last = rep
                groups.append({"of": {}, "text": {}, "count": {}})
            g = groups[-1]
            g["of"].setdefault(body, []).append((doc, start))
            g["count"][body] = count
            if text is not None and body not in g["text"]:
                g["text"][body] = text
                held += len(text)
    if groups and (out := _decide(groups)) is not None:
        yield out


def _hot_strings(rows, data, off):
    """The strings of hot regions by the hash of their bytes and 32 bits of their representative, which is
    another function of them: 96 bits decide."""
    doc, start, count, rep = _spread(rows)
    at = ragged(off[:-1][doc] + start, count)  # regions of a document do not overlap in their starts
    d = np.repeat(doc, count)
    more = np.repeat(mix(rep.view(np.uint64)), count).astype(np.uint32)
    return id_array(rows.column("doc_id")), np.diff(off), d, at - off[:-1][d], span_hash(prefix_hash(data), at, at + LENGTH), more


def _hot_spans(batches):
    for b in batches:
        ids, low, high = [], [], []
        for doc, hits in zip(b.column("doc_id").to_pylist(), b.column("hits").to_pylist(), strict=True):
            x = np.frombuffer(hits, "<u4").astype(np.int64)
            cut = np.flatnonzero(np.diff(x) != 1)
            i, j = x[np.concatenate([[0], cut + 1])], x[np.concatenate([cut, [len(x) - 1]])]
            ids += [doc] * len(i)
            low.append(i)
            high.append(j + LENGTH)
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(low).astype(np.int32)), pa.array(np.concatenate(high).astype(np.int32))],
                ["doc_id", "low", "high"])


def _cut(batches):
    for rows, data, off in chunks(batches):
        spans = rows.column("spans")
        doc = np.repeat(np.arange(len(spans)), np.diff(np.asarray(spans.offsets)))
        low, high = (spans.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("low", "high"))
        gone = covered(off[:-1][doc] + low, off[:-1][doc] + high, len(data))
        n, sha, removed = [], [], []
        for a, b in zip(off[:-1], off[1:], strict=True):
            m = gone[a:b]
            removed.append(int(m.sum()))
            n.append(int(np.count_nonzero(np.diff(m.view(np.int8), prepend=0) == 1)))
            sha.append(hashlib.sha256(data[a:b][~m].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(sha)],
            ["doc_id", "cut", "cut_spans", "cut_sha"])


def repeated_spans(texts: DataFrame, scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans (doc_id, low, high) that repeated strings cover, and doc_id, text of all documents
    looked into. `scanned` holds the regions of the documents to look at."""
    spark = texts.sparkSession
    each = stash(scanned.select("doc_id", F.explode(F.arrays_zip("start", "count", "rep", "places")).alias("r")).select("doc_id", "r.*"), "regions")
    found = stash(each.groupBy("rep").agg(F.sum("places").alias("places"), F.count(F.lit(1)).alias("cnt")).filter("places > 1"), "representatives")
    live = attach(each.drop("places"), found.drop("places"), "rep", each.count())
    struct = F.struct("start", "count", "rep")
    by_doc = live.groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("cnt") <= HOT_REGIONS, struct)).alias("regions"),
        F.collect_list(F.when(F.col("cnt") > HOT_REGIONS, struct)).alias("hot"))
    near = stash(texts.join(by_doc, "doc_id"), "region-texts")
    plain = (near.filter(F.size("regions") > 0).select("doc_id", "text", "regions").mapInArrow(_texts, _REGION)
             .repartition(n_parts(spark), "rep").sortWithinPartitions("rep")
             .mapInArrow(_sorted_regions, "doc_id long, low int, high int"))
    hot = near.filter(F.size("hot") > 0).select("doc_id", "text", F.col("hot").alias("regions"))
    rest = find_repeats(hot, _hot_strings, later=False).mapInArrow(_hot_spans, "doc_id long, low int, high int")
    return plain.unionByName(rest), near.select("doc_id", "text")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of `docs` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    # the key of a row: its doc_id, or a negative number by its text; ids given back are the original ones
    key = F.coalesce(F.col("doc_id"), F.xxhash64(F.lit("nameless"), F.coalesce(F.col("text"), F.lit(""))).bitwiseOR(F.lit(-(2**63))))
    named = docs.select(key.alias("doc_id"), "text", F.col("doc_id").isNull().alias("nameless"))
    texts = named.select("doc_id", "text")
    base = stash(named.mapInArrow(_scan, _SCAN), "byte-digests")
    small = base.select("doc_id", "nameless", "n_bytes", "sha")
    firsts = stash(small.distinct().groupBy("sha").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "byte-copies")
    originals = firsts.select(F.col("first_id").alias("doc_id"))
    scanned = base.filter(F.col("n_bytes") >= LENGTH).join(originals, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    spans, looked = repeated_spans(texts, scanned)
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    cuts = looked.join(by_doc, "doc_id").mapInArrow(
        _cut, "doc_id long, cut long, cut_spans long, cut_sha string").dropDuplicates(["doc_id"])
    rows = attach(small, firsts.withColumn("cnt", F.col("copies")), "sha", small.count()).join(cuts, "doc_id", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= LENGTH)
    zero = F.lit(0).cast("long")
    return rows.select(
        F.when(~F.col("nameless"), F.col("doc_id")).alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("cut", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("cut_spans", zero)).alias("n_spans"),
        F.when(whole, F.lit(_EMPTY)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir))
