"""MinHash near-dedup with an LSH forest.

1. One pass: each document's set of distinct 5-word shingles (64-bit hashes cut to 54 bits), its size, a
   128-bit digest of the set and N_HASHES minhashes. Documents with equal sets form a class, of
   which one row goes on.
2. An order is a sequence of minhashes; documents with equal first minhashes in it share a region. Those that share
   a region of the first level with any other give their full sets.
3. Forest: FIRST_ORDERS sorted signature orders, by range partitioning, so that crowded places spread over tasks.
   Rows next to each other, with the longest common prefixes, are compared on full sets and joined into
   components. This makes most groups of copies one component; nothing relies on what it misses.
4. Adaptive depth: at each of LEVELS (prefix length, orders) the regions that still hold several components are
   looked at. One of WHOLE rows or fewer is compared whole. The documents of larger ones go to the next level,
   with longer prefixes and more orders, but for the last level, where every such region is compared whole.
   Whole means every row outside the region's largest component against every row of the
   region, on full sets, in cells of about CELL by CELL rows or CELL_SHINGLES by CELL_SHINGLES shingles.
   A cell gives only links that join components. Components are merged after each level. No candidate is capped.

A pair of Jaccard similarity s shares a region with prefix length d in some of t orders with probability
1 - (1 - s**d)**t: at s = 0.75 all but 1.8e-6 at the first level and all but 5.2e-6 at the last. A pair is compared at the
first level unless all regions that it shares there are crowded; then both go to the last. Links are
confirmed on full sets, so there is no false link. A region of n rows of which m are outside its largest
component costs m * n comparisons, spread over cells, and gives at most n - 1 links a cell.

Cases: null, empty and blank texts have an empty set and are their own component; texts under 5
words have one shingle; ties cannot arise; rows that repeat a doc_id get the same verdict; a null
doc_id links nothing and stands for no group unless it is alone in it; empty
tables give empty results; extra input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import (
    Words, arrow_batches, attach, chunks, documents, drop, grams, mix, n_parts, ragged, sort_runs, stash,
)
from keymend.llm.components import components

SHINGLE = 5
PERCENT = 75
N_HASHES = 128
#: Prefix length and number of orders at each level; orders of a level are cut from the N_HASHES minhashes.
LEVELS = ((2, 16), (4, 32))
#: Rows up to which a region is compared whole instead of being looked at more deeply.
WHOLE = 128
#: Orders that are sorted, the minhashes in each, and the rows after a row that it is compared with.
FIRST_ORDERS = 2
DEPTH = 8
REACH = 8
#: Rows, and shingles, on either side of a cell.
CELL = 1024
CELL_SHINGLES = 1 << 20
#: Pairs up to which a cell is compared pair by pair instead of by a product of matrices; shingles in a slab of one.
FEW = 256
SLAB = 2048
_BITS = 54

_rng = np.random.Generator(np.random.PCG64(7))
_MUL = (_rng.integers(0, 2**31, N_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)).astype(np.uint32)
_XOR = _rng.integers(0, 2**32, N_HASHES, dtype=np.uint32)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each document of a chunk, joined, and each set's size."""
    w = Words(data, off, lower=True)
    n = len(off) - 1
    g = grams(w.hash, SHINGLE)
    ok = np.flatnonzero(w.doc[SHINGLE - 1 :] == w.doc[: len(g)]) if len(g) else np.empty(0, np.int64)
    short = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
    s = mix(w.count[short].astype(np.uint64) + np.uint64(0x1234567))
    for j in range(SHINGLE - 1):
        use = w.count[short] > j
        at = np.minimum(w.first[:-1][short] + j, len(w.hash) - 1)
        s = np.where(use, s * np.uint64(0xD6E8FEB86659FD93) + w.hash[at], s) if len(short) else s
    doc = np.concatenate([w.doc[ok], short]).astype(np.uint64)
    key = np.concatenate([g[ok], mix(s)])
    key = np.sort((doc << np.uint64(_BITS)) | (key >> np.uint64(64 - _BITS)))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    size = np.bincount((key >> np.uint64(_BITS)).astype(np.int64), minlength=n)
    return key & np.uint64((1 << _BITS) - 1), size


def signatures(sets: np.ndarray, size: np.ndarray, n: int = N_HASHES) -> np.ndarray:
    """Minhashes (documents with a shingle only, in order)."""
    full = size[size > 0]
    start = np.cumsum(full) - full
    out = np.empty((len(full), n), np.uint32)
    if len(full):
        x = (mix(sets) >> np.uint64(32)).astype(np.uint32)
        for i in range(n):
            out[:, i] = np.minimum.reduceat((x ^ _XOR[i]) * _MUL[i], start)
    return out


def _signed(batches):
    for rows, data, off in chunks(batches):
        sets, size = shingle_sets(data, off)
        has = size > 0
        full = size[has]
        start = np.cumsum(full) - full
        lanes = np.zeros((len(size), 2), np.uint64)
        if len(full):
            lanes[has, 0] = np.add.reduceat(mix(sets + np.uint64(1)), start)
            lanes[has, 1] = np.add.reduceat(mix(sets ^ np.uint64(0x5DEECE66D5DEECE6)), start)
        sig = np.zeros((len(size), N_HASHES), ">u4")
        sig[has] = signatures(sets, size)
        raw = sig.tobytes()
        step = N_HASHES * 4
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array(size.astype(np.int64)), pa.array([x.tobytes() for x in lanes], pa.binary()),
             pa.array([raw[i * step : (i + 1) * step] if h else None for i, h in enumerate(has)], pa.binary())],
            ["doc_id", "n_shingles", "class", "signature"])


def _in_order(rows: DataFrame) -> DataFrame:
    """FIRST_ORDERS rows a document: tree, key (the order's minhashes, comparable as bytes), sorted."""
    n = n_parts(rows.sparkSession)
    each = rows.withColumn("tree", F.explode(F.array(*(F.lit(t) for t in range(FIRST_ORDERS)))))
    keyed = each.select("tree", F.expr(f"substring(signature, tree * {DEPTH * 4} + 1, {DEPTH * 4})").alias("key"), "doc_id", "n_shingles", "shingles")
    return keyed.repartitionByRange(n, "tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")


def _prefixes(tree: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row's key and the next row's."""
    same = np.logical_and.accumulate(key[1:] == key[:-1], axis=1).sum(1)
    return np.where(tree[1:] == tree[:-1], same, 0)


def _fits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes that allow the similarity."""
    return 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)


def _columns(batch, *names):
    out = []
    for c in names:
        col = batch.column(batch.schema.get_field_index(c))
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        if pa.types.is_binary(col.type):
            out.append(np.frombuffer(b"".join(col.to_pylist()), ">u4").reshape(-1, DEPTH))
        else:
            out.append(col.to_numpy(zero_copy_only=False).astype(np.int64))
    return out


def _near_pairs(tree, key, size):
    """Index pairs (i < j <= i + REACH) with a common prefix, of fitting sizes."""
    lcp = _prefixes(tree, key)
    run = np.full(len(tree), DEPTH)
    for j in range(1, REACH + 1):
        if len(tree) <= j:
            break
        run = np.minimum(run[: len(tree) - j], lcp[j - 1 :])
        i = np.flatnonzero((run >= LEVELS[0][0]) & _fits(size[:-j], size[j:]))
        yield i, i + j


def _sets(batches):
    for rows, data, off in chunks(batches):
        sets, size = shingle_sets(data, off)
        raw = sets.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
        end = np.cumsum(size) * 7
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([raw[e - 7 * n : e] for e, n in zip(end.tolist(), size.tolist(), strict=True)], pa.binary())],
            ["doc_id", "shingles"])


def _read_set(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 7)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :7] = raw
    return out.view("<u8").reshape(-1)


def similar(a: bytes, b: bytes) -> bool:
    x, y = _read_set(a), _read_set(b)
    both = np.sort(np.concatenate([x, y]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def _links_on_the_spot(batches):
    """Links among neighbours whose sets are at hand; a batch takes over the last rows before it."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, key, size, ids = _columns(batch, "tree", "key", "n_shingles", "doc_id")
        sets = batch.column(batch.schema.get_field_index("shingles")).to_pylist()
        if held is not None:
            tree, key, size, ids = (np.concatenate([a[-REACH:], b]) for a, b in zip(held, (tree, key, size, ids), strict=True))
            sets = held_sets[-REACH:] + sets  # noqa: F821
        union = _Union(len(ids))
        a, b = [], []
        for i, j in _near_pairs(tree, key, size):
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                p, q = union.find(x), union.find(y)
                if p != q and similar(sets[x], sets[y]):
                    union.up[p] = q
                    a.append(int(ids[x]))
                    b.append(int(ids[y]))
        held, held_sets = (tree, key, size, ids), sets  # noqa: F841
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


# --- cells ---------------------------------------------------------------------------------

def _common(sets: list[np.ndarray], query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets at `query` and at `row`, by products of 0-1 matrices
    of the shingles that two sets or more hold."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keys = np.concatenate(sets)
    order = np.argsort(keys, kind="stable")
    at, n = sort_runs(keys[order])
    at, n = at[n > 1], n[n > 1]
    held, col = of[order[ragged(at, n)]], np.repeat(np.arange(len(at)), n)
    edge = np.searchsorted(col, np.arange(0, len(at) + SLAB, SLAB))
    out = np.zeros((len(query), len(row)), np.float32)
    for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        x = np.zeros((len(sets), SLAB), np.float32)
        x[held[a:b], col[a:b] - k * SLAB] = 1
        out += x[query] @ x[row].T
    return out.astype(np.int64)


def cell_links(ids, size, comp, main, row, query, shingles) -> list[tuple[int, int]]:
    """Links between components among the pairs of a query and a row of a cell. Two rows outside the
    main component meet twice, perhaps in two cells; the one with the smaller id is the row then."""
    q, r = np.flatnonzero(query), np.flatnonzero(row)
    ok = _fits(size[q, None], size[r]) & (comp[q, None] != comp[r]) & ((comp[r] == main[r]) | (ids[r] < ids[q, None]))
    if not ok.any():
        return []
    kinds, kind = np.unique(comp, return_inverse=True)
    if ok.sum() <= FEW:
        exact = lambda i, j: similar(shingles[q[i]], shingles[r[j]])
    else:
        both = _common([_read_set(x) for x in shingles], q, r)
        ok &= 100 * both >= PERCENT * (size[q, None] + size[r] - both)
        exact = lambda i, j: True
    union, out = _Union(len(kinds)), []
    for i, j in np.argwhere(ok).tolist():
        x, y = union.find(kind[q[i]]), union.find(kind[r[j]])
        if x != y and exact(i, j):
            union.up[x] = y
            out.append((int(comp[q[i]]), int(comp[r[j]])))
    return out


_CELL = ("tree", "region", "block", "lot")


def _links_in_cells(batches):
    """Rows come sorted by cell; a cell that a batch leaves open goes on in the next."""
    held: pa.Table | None = None

    def links(t: pa.Table):
        col = {c: t.column(c).to_numpy() for c in ("doc_id", "n_shingles", "component", "main", *_CELL, "own_block", "own_lot")}
        sets = t.column("shingles").to_pylist()
        cell = np.stack([col[c] for c in _CELL])
        cut = np.flatnonzero(np.concatenate([[True], (cell[:, 1:] != cell[:, :-1]).any(0), [True]]))
        row = col["block"] == col["own_block"]
        query = (col["lot"] == col["own_lot"]) & (col["component"] != col["main"])
        found = []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            found += cell_links(*(col[c][a:b] for c in ("doc_id", "n_shingles", "component", "main")), row[a:b], query[a:b], sets[a:b])
        low, high = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1).T
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        last = [t.column(c)[-1].as_py() for c in _CELL]
        same = np.logical_and.reduce([t.column(c).to_numpy() == v for c, v in zip(_CELL, last, strict=True)])
        start = int(np.argmax(same))  # of the last cell
        held = t.slice(start)
        if start:
            yield links(t.slice(0, start))
    if held is not None:
        yield links(held)


def _regions(signed: DataFrame, level: int) -> DataFrame:
    """tree, region, doc_id: a row for each document and order of the level."""
    depth, orders = LEVELS[level]
    each = signed.withColumn("tree", F.explode(F.array(*(F.lit(t) for t in range(orders)))))
    prefix = F.expr(f"substring(signature, tree * {N_HASHES // orders * 4} + 1, {depth * 4})")
    return each.select("tree", F.xxhash64(prefix).alias("region"), "doc_id", "n_shingles")


def _level(keys: DataFrame, where: DataFrame, sets: DataFrame, total: int, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) between components of `where` (doc_id, component) from the regions in `keys` that hold
    several; and the documents (doc_id) of those that have to be looked at more deeply."""
    placed = keys.join(where, "doc_id")
    shares = placed.groupBy("tree", "region", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"))
    regions = shares.groupBy("tree", "region").agg(
        F.sum("n").alias("cnt"), F.sum("weight").alias("weight"), F.max(F.struct("n", "weight", "component")).alias("most"),
        F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    parts = lambda n, w: F.ceil(F.greatest(n / CELL, w / CELL_SHINGLES)).cast("int")
    regions = stash(regions.select(
        "tree", "region", "cnt", F.col("most.component").alias("main"), parts(F.col("cnt"), F.col("weight")).alias("blocks"),
        parts(F.col("cnt") - F.col("most.n"), F.col("weight") - F.col("most.weight")).alias("lots")), "several")
    place = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    now = regions if last else regions.filter(F.col("cnt") <= WHOLE)
    members = attach(placed, now, ["tree", "region"], total).withColumns({"own_block": place("blocks"), "own_lot": place("lots")})
    cells = members.withColumn("cell", F.explode(F.expr(
        "array_union(transform(sequence(0, lots - 1), x -> struct(own_block as block, x as lot)), "
        "if(component <> main, transform(sequence(0, blocks - 1), x -> struct(x as block, own_lot as lot)), array()))")))
    cells = cells.join(sets, "doc_id").select(
        "tree", "region", "cell.block", "cell.lot", "own_block", "own_lot", "doc_id", "component", "main", "n_shingles", "shingles")
    links = (cells.repartition(n_parts(cells.sparkSession), *_CELL).sortWithinPartitions(*_CELL)
             .mapInArrow(_links_in_cells, "a long, b long"))
    if last:
        return links, None
    deeper = regions.filter(F.col("cnt") > WHOLE)
    return links, attach(keys.select("tree", "region", "doc_id"), deeper, ["tree", "region"], total).select("doc_id").distinct()


def _merged(where: DataFrame, links: DataFrame) -> DataFrame:
    """`where` (doc_id, component) after links between components."""
    whole = components(links).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return stash(where.join(whole, "component", "left").select("doc_id", F.coalesce("whole", "component").alias("component")), "where")


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text)."""
    arrow_batches(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    base = stash(texts.mapInArrow(_signed, "doc_id long, n_shingles long, class binary, signature binary"), "signatures")
    light = base.select("doc_id", "n_shingles", "class")
    some = light.filter("n_shingles > 0")
    classes = stash(some.groupBy("class").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("cnt")), "classes")
    reps = base.join(classes.select(F.col("rep").alias("doc_id"), "class"), ["doc_id", "class"], "left_semi")
    reps = stash(reps.select("doc_id", "n_shingles", "signature").dropDuplicates(["doc_id"]), "representatives")
    # documents that share a region, and their sets
    keys = _regions(reps, 0)
    shared = stash(keys.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "regions")
    keys = stash(attach(keys, shared, ["tree", "region"], reps.count() * LEVELS[0][1]).drop("cnt"), "keys")
    near = stash(reps.join(keys.select("doc_id").distinct(), "doc_id", "left_semi"), "near-signatures")
    sets = stash(texts.join(near.select("doc_id"), "doc_id", "left_semi").mapInArrow(
        _sets, "doc_id long, shingles binary").dropDuplicates(["doc_id"]), "sets")
    # neighbours in sorted orders
    found = components(_in_order(near.join(sets, "doc_id")).mapInArrow(_links_on_the_spot, "a long, b long"))
    where = stash(near.select("doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("component")), "where")
    # regions, deeper where they are crowded
    for level in range(len(LEVELS)):
        links, deeper = _level(keys, where, sets, keys.count(), level == len(LEVELS) - 1)
        before, spent = where, keys
        where = _merged(where, links)
        if deeper is not None:
            keys = stash(_regions(near.join(deeper, "doc_id", "left_semi"), level + 1), "keys")
        drop(before, spent)
    drop(near, sets, shared)
    where = reps.select("doc_id").join(where, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component"))
    final = where.withColumnRenamed("doc_id", "rep")
    labels = stash(classes.join(final, "rep", "left").select("class", "cnt", F.coalesce("component", "rep").alias("component_id")), "labels")
    rows = attach(some, labels, "class", light.count()).select("doc_id", "n_shingles", "component_id")
    rows = rows.unionByName(light.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op1_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(documents(spark, sf_dir))
