"""Finding repeated items (word windows, byte strings) of all documents in packed numpy blocks.

Items of a few thousand documents form a block. A block keeps what it can see alone (an item that
it holds twice is a repeat) and sends each distinct item once, packed by key range, to buckets; so
a bucket gets at most one message of a block for an item, however often the item occurs.
Buckets answer each block with the places whose item is held by another block too. Blocks are
numbered by scan partition and sequence, which a repeated task repeats."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keymend.llm.common import chunks, n_buckets, sort_runs

#: Items gathered before a block is closed.
BLOCK_ITEMS = 1_500_000

#: For a chunk: each document's id, its number of positions, and of the items the document
#: index, position in it, 64-bit key and (or None) 32 more bits of the key.
Items = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]

_MESSAGE = "bucket int, block long, keys binary, more binary, places binary, wide boolean, docs binary, base binary, head boolean"
_FIELDS = [x.split()[0] for x in _MESSAGE.split(", ")]
_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.binary(), pa.bool_()]


def _pack_keys(k: np.ndarray, n: int) -> bytes:
    return k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def _unpack_keys(b: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, n)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :n] = raw
    return out.view("<u8").reshape(-1)


def _pack_places(x: np.ndarray) -> tuple[bytes, bool]:
    d = np.diff(x, prepend=0)
    wide = bool(len(d)) and int(d.max()) > 65535
    return d.astype(np.uint32 if wide else np.uint16).tobytes(), wide


def _unpack_places(b: bytes, wide: bool) -> np.ndarray:
    return np.cumsum(np.frombuffer(b, np.uint32 if wide else np.uint16).astype(np.int64))


class _Block:
    def __init__(self):
        self.docs, self.sizes, self.items, self.n = [], [], [], 0

    def add(self, docs, sizes, doc, pos, key, more):
        shift = sum(map(len, self.docs))
        self.docs.append(docs)
        self.sizes.append(sizes)
        self.items.append((doc + shift, pos, key, more))
        self.n += len(key)

    def rows(self, block: int, buckets: int, later: bool, key_bytes: int):
        docs, sizes = np.concatenate(self.docs), np.concatenate(self.sizes)
        rank = np.empty(len(docs), np.int64)
        order = np.argsort(docs, kind="stable")
        rank[order] = np.arange(len(docs))
        docs, sizes = docs[order], sizes[order]
        base = np.cumsum(sizes) - sizes
        doc = rank[np.concatenate([x[0] for x in self.items])]
        place = base[doc] + np.concatenate([x[1] for x in self.items])
        key = np.concatenate([x[2] for x in self.items])
        more = None if self.items[0][3] is None else np.concatenate([x[3] for x in self.items])
        by = np.argsort(place, kind="stable")  # by document, then position
        place, key, more = place[by], key[by], None if more is None else more[by]
        by = np.argsort(key, kind="stable")
        at, length = sort_runs(key[by])
        if later:
            # all but the first; a row that repeats the first's document is no later start
            first = by[np.repeat(at, length)]
            d = np.searchsorted(base, place, "right") - 1
            same = (docs[d[by]] == docs[d[first]]) & (place[by] - base[d[by]] == place[first] - base[d[first]])
            known = np.sort(by[~same])
        else:
            known = np.sort(by[np.repeat(length, length) > 1])
        send = np.sort(by[at])
        to = (key[send] % np.uint64(buckets)).astype(np.int64)
        send = send[np.argsort(to, kind="stable")]
        cuts = np.searchsorted(np.sort(to), np.arange(buckets + 1))
        table, starts = docs.astype("<i8").tobytes(), base.astype("<i8").tobytes()

        def ids(s):
            """Of the table, the documents that the items of a message stand in: never more than the items."""
            if not later:
                return None, None
            used = np.unique(np.searchsorted(base, place[s], "right") - 1)
            return docs[used].astype("<i8").tobytes(), base[used].astype("<i8").tobytes()

        out = [[] for _ in _FIELDS]
        for b in range(buckets):
            if cuts[b] < cuts[b + 1]:
                s = send[cuts[b] : cuts[b + 1]]
                places, wide = _pack_places(place[s])
                quotient = key[s] // np.uint64(buckets)
                row = (b, block, _pack_keys(quotient, key_bytes), None if more is None else more[s].tobytes(), places, wide, *ids(s), False)
                for col, v in zip(out, row, strict=True):
                    col.append(v)
        places, wide = _pack_places(place[known])
        for col, v in zip(out, (block % buckets, block, None, None, places, wide, table, starts, True), strict=True):
            col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _TYPES, strict=True)], _FIELDS)


def _sender(items: Items, buckets: int, later: bool, key_bytes: int):
    def send(batches):
        block, seq = _Block(), 0
        part = TaskContext.get().partitionId()
        for rows, data, off in chunks(batches):
            block.add(*items(rows, data, off))
            if block.n >= BLOCK_ITEMS:
                yield from block.rows((part << 24) + seq, buckets, later, key_bytes)
                block, seq = _Block(), seq + 1
        if block.docs:
            yield from block.rows((part << 24) + seq, buckets, later, key_bytes)
    return send


_REPLY = "block long, places binary, wide boolean, docs binary, base binary"
_REPLY_TYPES = [pa.int64(), pa.binary(), pa.bool_(), pa.binary(), pa.binary()]


def _bucket(later: bool, key_bytes: int):
    def match(t: pa.Table) -> pa.Table:
        col = {c: t.column(c).to_pylist() for c in ("block", "keys", "more", "places", "wide", "docs", "base", "head")}
        out = [[], [], [], [], []]
        mail = []
        for i, head in enumerate(col["head"]):
            if head:
                for c, v in zip(out, (col["block"][i], col["places"][i], col["wide"][i], col["docs"][i], col["base"][i]), strict=True):
                    c.append(v)
            else:
                mail.append(i)
        if mail:
            keys = np.concatenate([_unpack_keys(col["keys"][i], key_bytes) for i in mail])
            place = [_unpack_places(col["places"][i], col["wide"][i]) for i in mail]
            who = np.repeat(np.arange(len(mail)), [len(p) for p in place])
            flat = np.concatenate(place)
            more = None if col["more"][mail[0]] is None else np.concatenate([np.frombuffer(col["more"][i], np.uint32) for i in mail])
            if later:
                ids, pos = [], []
                for i, p in zip(mail, place, strict=True):
                    base = np.frombuffer(col["base"][i], "<i8")
                    d = np.searchsorted(base, p, "right") - 1
                    ids.append(np.frombuffer(col["docs"][i], "<i8")[d])
                    pos.append(p - base[d])
                ids, pos = np.concatenate(ids), np.concatenate(pos)
                by = np.lexsort((pos, ids, more, keys))
                new = np.concatenate([[True], (keys[by][1:] != keys[by][:-1]) | (more[by][1:] != more[by][:-1])])
                first = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
                hit = by[(ids[by] != ids[first]) | (pos[by] != pos[first])]
            else:
                by = np.argsort(keys) if more is None else np.lexsort((more, keys))
                new = keys[by][1:] != keys[by][:-1]
                if more is not None:
                    new |= more[by][1:] != more[by][:-1]
                _, length = sort_runs(np.concatenate([[0], np.cumsum(new)]))
                hit = by[np.repeat(length, length) > 1]
            hit = np.sort(hit)
            cuts = np.searchsorted(who[hit], np.arange(len(mail) + 1))
            for j, i in enumerate(mail):
                if cuts[j] < cuts[j + 1]:
                    places, wide = _pack_places(flat[hit[cuts[j] : cuts[j + 1]]])
                    for c, v in zip(out, (col["block"][i], places, wide, None, None), strict=True):
                        c.append(v)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(out, _REPLY_TYPES, strict=True)], ["block", "places", "wide", "docs", "base"])
    return match


def _answer(t: pa.Table) -> pa.Table:
    docs = base = None
    places = []
    for p, w, d, b in zip(*(t.column(c).to_pylist() for c in ("places", "wide", "docs", "base")), strict=True):
        places.append(_unpack_places(p, w))
        if d is not None:
            docs, base = np.frombuffer(d, "<i8"), np.frombuffer(b, "<i8")
    place = np.unique(np.concatenate(places))
    # of documents without positions, which share their base with the next, the last one is meant
    d = np.searchsorted(base, place, "right") - 1
    at, length = sort_runs(d)
    hits = [(place[i : i + n] - base[d[i]]).astype("<u4").tobytes() for i, n in zip(at, length, strict=True)]
    return pa.Table.from_arrays([pa.array(docs[d[at]], pa.int64()), pa.array(hits, pa.binary())], ["doc_id", "hits"])


def find_repeats(rows: DataFrame, items: Items, later: bool, key_bytes: int = 8) -> DataFrame:
    """doc_id and hits (packed uint32 positions) of the documents of `rows` that hold repeated
    items: with `later`, an item that also stands earlier (smaller doc_id, or the same document
    and a smaller position); otherwise any item that stands in more than one place. `key_bytes`
    cuts keys short where a rare false hit does no harm."""
    buckets = n_buckets(rows)
    mail = rows.mapInArrow(_sender(items, buckets, later, key_bytes), _MESSAGE)
    replies = mail.groupBy("bucket").applyInArrow(_bucket(later, key_bytes), _REPLY)
    return replies.groupBy("block").applyInArrow(_answer, "doc_id long, hits binary").filter(F.length("hits") > 0)
