"""LM scoring with a Brown class model: P(w | w') = P(class(w) | class(w')) P(w | class(w)).

1. Frequent words: the exact training counts of all words are added up by word; the TOP most frequent (ties by hash) get their bigram counts with each other, complete over all training texts.
2. Exchange clustering on the driver (TOP is fixed, so is the table): each word moves to the class that raises the likelihood of
   the class bigrams most, until no word moves. This gives the initial classes.
3. Exact counts of all words: texts are turned into blocks of word numbers; each block sends its distinct
   words with their training counts, and how often they stand before and after each initial class, to buckets by
   hash, which add up and answer. So the traffic and the state grow with the corpus' vocabulary, and no task or machine holds it whole.
   Every further word seen ASSIGN times or more goes to the class whose likelihood gains most from its added-up
   contexts; so the clustered vocabulary grows with the corpus. Words seen less often, and words that never
   stand beside a frequent word or a text's edge, fall into classes by the power of two of their count; words seen once and
   words never seen share a class, split by how often held-out tokens of it are new.
4. Class sequences of the training texts give class-transition counts, smoothed with the class
   frequencies; each text is scored from its class sequence and its words' emissions.

Cases: null and empty texts are the end token alone; without training rows every count is 0 and
the model is uniform over its classes; repeated rows each count and each get a row; empty tables
give empty results; extra input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import Words, add_slices, arrow_batches, chunks, documents, id_array, ids_back, n_parts, sort_runs, stash

#: Words that take part in the exchange, and the classes they go to.
TOP = 1000
CLASSES = 48
#: Word counts of chunks that a scan task holds before it gives them out.
HELD_WORDS = 2_000_000
#: Training count from which the other words go to a class by their contexts.
ASSIGN = 4
#: Classes: exchange classes, the end token, then words by the power of two of their count (0: seen once or never).
END = CLASSES
BANDS = 48
KINDS = CLASSES + 1 + BANDS
#: Weight of the class frequencies in a transition's smoothing.
SMOOTH = 20.0
BLOCK_TOKENS = 1_500_000


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def _frequent(batches):
    """Training counts of words, given out whenever many are held; so a word may come more than once."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for rows, data, off in chunks(batches):
        w = Words(data, off, lower=True)
        train = ~np.asarray(rows.column("held_out").to_numpy(zero_copy_only=False), bool)
        u, c = np.unique(w.hash[train[w.doc]], return_counts=True)
        keys, counts = np.concatenate([keys, u]), np.concatenate([counts, c])
        if len(keys) > HELD_WORDS:
            yield _counted(keys, counts)
            keys, counts = keys[:0], counts[:0]
    yield _counted(keys, counts)


def _counted(keys, counts):
    keys, counts = _merged(keys, counts)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"])


def _merged(keys, counts):
    order = np.argsort(keys, kind="stable")
    at, _ = sort_runs(keys[order])
    return keys[order][at], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


_ROW = "kind int, block long, bucket int, a binary, b binary, c binary, d binary, cuts binary"
_ROW_TYPES = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
_ROW_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _planes(x: np.ndarray) -> bytes:
    """Three byte planes of numbers below 2**24, which pack well."""
    raw = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.ascontiguousarray(raw[:, :3].T).tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    p = np.frombuffer(b, np.uint8).reshape(3, -1).astype(np.int64)
    return p[0] | p[1] << 8 | p[2] << 16


class _Block:
    def __init__(self):
        self.ids, self.held, self.size, self.words, self.n = [], [], [], [], 0

    def add(self, rows, w: Words):
        self.ids.append(id_array(rows.column("doc_id")))
        self.held.append(np.asarray(rows.column("held_out").to_numpy(zero_copy_only=False), bool))
        self.size.append(w.count)
        self.words.append(w.hash)
        self.n += len(w.hash) + w.n_docs

    def rows(self, block: int, buckets: int, top: np.ndarray):
        """Block rows: 0 the texts, 1 messages to buckets, 2 counts of the frequent words."""
        ids, held, size, words = (np.concatenate(x) for x in (self.ids, self.held, self.size, self.words))
        u, which = np.unique(words, return_inverse=True)
        at = np.minimum(np.searchsorted(top, u), max(len(top) - 1, 0))
        is_top = top[at] == u if len(top) else np.zeros(len(u), bool)
        number = np.empty(len(u), np.int64)
        number[is_top] = at[is_top]
        rest = np.flatnonzero(~is_top)
        to = (u[rest] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        rest, to = rest[order], to[order]
        number[rest] = TOP + 1 + np.arange(len(rest))
        # the token sequence: each text's words, then the end
        seq = np.full(len(words) + len(size), TOP, np.int64)
        last = np.cumsum(size + 1) - 1
        word_at = np.ones(len(seq), bool)
        word_at[last] = False
        seq[word_at] = number[which]
        train = np.repeat(~held, size)
        count = np.bincount(which[train], minlength=len(u)).astype("<u4")
        out = [[] for _ in _ROW_NAMES]

        def put(*row):
            for col, v in zip(out, row, strict=True):
                col.append(v)

        cuts = np.searchsorted(to, np.arange(buckets + 1))
        put(0, block, -1, ids.astype("<i8").tobytes(), (size + 1).astype("<i8").tobytes(), held.tobytes(), _planes(seq), cuts.astype("<i8").tobytes())
        for b in range(buckets):
            if cuts[b] < cuts[b + 1]:
                part = rest[cuts[b] : cuts[b + 1]]
                put(1, block, b, u[part].tobytes(), count[part].tobytes(), None, None, None)
        before = np.concatenate([[TOP], seq[:-1]])
        use = np.repeat(~held, size + 1)
        pair = use & (before <= TOP) & (seq <= TOP)
        code, n = np.unique(before[pair] * (TOP + 1) + seq[pair], return_counts=True)
        single = np.bincount(seq[use & (seq <= TOP)], minlength=TOP + 1)
        put(2, block, -1, code.astype("<i8").tobytes(), n.astype("<i8").tobytes(), single.astype("<i8").tobytes(), None, None)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _ROW_TYPES, strict=True)], _ROW_NAMES)


def _blocks(buckets: int, top: np.ndarray):
    def cut(batches):
        block, seq = _Block(), 0
        part = TaskContext.get().partitionId()
        for rows, data, off in chunks(batches):
            block.add(rows, Words(data, off, lower=True))
            if block.n >= BLOCK_TOKENS:
                yield from block.rows((part << 24) + seq, buckets, top)
                block, seq = _Block(), seq + 1
        if block.ids:
            yield from block.rows((part << 24) + seq, buckets, top)
    return cut


def _band(c: np.ndarray) -> np.ndarray:
    return np.where(c < 2, 0, np.floor(np.log2(np.maximum(c, 1))).astype(np.int64))


def _small(x: np.ndarray) -> bytes:
    """Four byte planes of counts, most of which are small."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_small(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


#: Contexts of a word: the initial class or text's edge before it, then those after it.
SIDES = 2 * (CLASSES + 1)


def _contexts(top_class: np.ndarray):
    """A block's messages: for each bucket's words, in the order of its counts, how many contexts each
    has (a), which (b) and how often (c), in the training texts."""
    def send(batches):
        for rows in batches:
            out = [[] for _ in range(5)]
            col = {c: rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("block", "b", "c", "d", "cuts")}
            for block, size, held, seq, cuts in zip(*col.values(), strict=True):
                seq, cuts = _from_planes(seq), np.frombuffer(cuts, "<i8")
                use = np.repeat(~np.frombuffer(held, bool), np.frombuffer(size, "<i8"))
                known = np.append(top_class, END)[np.minimum(seq, TOP)]
                # every text ends with the end token, so each begins after one and no step of a text leaves it
                codes = []
                for side, near in ((0, np.concatenate([[END], known[:-1]])), (1, np.append(known[1:], END))):
                    by = np.concatenate([[TOP], seq[:-1]]) if not side else np.append(seq[1:], TOP)
                    pick = use & (seq > TOP) & (by <= TOP)
                    codes.append((seq[pick] - TOP - 1) * SIDES + side * (CLASSES + 1) + near[pick])
                code, n = np.unique(np.concatenate(codes), return_counts=True)
                word, slot = code // SIDES, code % SIDES
                at = np.searchsorted(word, cuts)
                for b in np.flatnonzero(np.diff(at)):
                    i, j = at[b], at[b + 1]
                    per = np.bincount(word[i:j] - cuts[b], minlength=cuts[b + 1] - cuts[b])
                    for c, v in zip(out, (block, int(b), _small(per), slot[i:j].astype(np.uint8).tobytes(), _small(n[i:j])), strict=True):
                        c.append(v)
            types = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["block", "bucket", "per", "slot", "n"])
    return send


def _ent(x):
    return x * np.log(np.maximum(x, 1))


def assign(table: np.ndarray, word: np.ndarray, slot: np.ndarray, n: np.ndarray, words: int) -> np.ndarray:
    """For each of `words` words with contexts (word, slot, n; sorted by word), the class whose likelihood in the class
    bigrams `table` of the initial classes gains most; -1 for words without contexts."""
    k = CLASSES
    best = np.full(words, -1, np.int64)
    after = slot > k
    other = np.where(after, slot - k - 1, slot)
    base = np.concatenate([table[:, :k], table.T[:, :k]])  # by slot: counts with each class, for a word after it and before it
    flat = _ent(base)
    row, col = table.sum(1)[:k], table.sum(0)[:k]
    at, length = sort_runs(word)
    for i in range(0, len(at), 4096):
        a, m = at[i : i + 4096], length[i : i + 4096]
        part = slice(a[0], a[-1] + m[-1])
        line = other[part] + (k + 1) * after[part]
        count = n[part, None].astype(float)
        gain = np.add.reduceat(_ent(base[line] + count) - flat[line], a - a[0], axis=0)
        out_n = np.add.reduceat(n[part] * after[part], a - a[0])[:, None]
        in_n = np.add.reduceat(n[part] * ~after[part], a - a[0])[:, None]
        gain -= _ent(row + out_n) - _ent(row) + _ent(col + in_n) - _ent(col)
        best[word[a]] = np.argmax(gain, axis=1)
    return best


def _totals(table: np.ndarray):
    """A bucket's answers: the training count and the class of each word of each message; and its sums by
    class (block null): tokens and types."""
    def add(t: pa.Table) -> pa.Table:
        col = {c: t.column(c).to_pylist() for c in ("block", "a", "b", "per", "slot", "n")}
        bucket = t.column("bucket")[0].as_py()
        mail = [i for i, k in enumerate(col["a"]) if k is not None]
        keys = [np.frombuffer(col["a"][i], np.uint64) for i in mail]
        cuts = np.cumsum([0, *map(len, keys)])
        unique, which = np.unique(np.concatenate(keys), return_inverse=True)
        own = np.concatenate([np.frombuffer(col["b"][i], "<u4") for i in mail]).astype(np.int64)
        total = np.zeros(len(unique), np.int64)
        np.add.at(total, which, own)
        kind = END + 1 + _band(total)
        first = {col["block"][i]: c for i, c in zip(mail, cuts[:-1], strict=True)}
        codes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for block, per, slot, n in zip(col["block"], col["per"], col["slot"], col["n"], strict=True):
            if per is not None:
                per = _from_small(per)
                word = which[first[block] : first[block] + len(per)].repeat(per)
                often = total[word] >= ASSIGN
                codes.append(word[often] * SIDES + np.frombuffer(slot, np.uint8)[often])
                counts.append(_from_small(n)[often])
        code, n = _merged(np.concatenate(codes).astype(np.uint64), np.concatenate(counts))
        code = code.astype(np.int64)
        best = assign(table, code // SIDES, code % SIDES, n, len(unique))
        kind = np.where(best >= 0, best, kind)
        rows = [(col["block"][i], bucket, total[which[a:b]].astype("<u4").tobytes(), kind[which[a:b]].astype(np.uint8).tobytes(), None, None, None)
                for i, a, b in zip(mail, cuts[:-1], cuts[1:], strict=True)]
        seen = total > 0
        for k in np.unique(kind[seen]):
            of = seen & (kind == k)
            rows.append((None, bucket, None, None, int(k), int(total[of].sum()), int(of.sum())))
        names = ["block", "bucket", "counts", "kinds", "kind", "tokens", "types"]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=True)], names)
    return add


def _add_pairs(key: str):
    def add(t: pa.Table) -> pa.Table:
        code = np.concatenate([np.frombuffer(x, "<i8") for x in t.column("a").to_pylist()])
        n = np.concatenate([np.frombuffer(x, "<i8") for x in t.column("b").to_pylist()])
        single = np.sum([np.frombuffer(x, "<i8") for x in t.column("c").to_pylist()], axis=0)
        code, n = _merged(code.astype(np.uint64), n)
        return pa.table({key: t.column(key).slice(0, 1), "a": pa.array([code.astype("<i8").tobytes()], pa.binary()),
                         "b": pa.array([n.astype("<i8").tobytes()], pa.binary()), "c": pa.array([single.astype("<i8").tobytes()], pa.binary())})
    return add


def exchange(pairs: np.ndarray, classes: int) -> np.ndarray:
    """Classes of the words of a bigram count table (last row and column: the end token, which keeps a
    class of its own) by exchange clustering, until no word moves. Each move raises the likelihood by more than what
    rounding can feign, so that the moves end."""
    n = len(pairs) - 1
    k = min(classes, max(n, 1))
    of = np.append(np.arange(n) % k, k)
    size = k + 1
    hot = np.eye(size)[of]
    left, right = pairs.T @ hot, pairs @ hot  # counts with the classes before and after a word
    table = hot.T @ right
    out_n, in_n = pairs.sum(1), pairs.sum(0)
    own = np.diag(pairs)

    def ent(x):
        return x * np.log(np.maximum(x, 1))

    total = pairs.sum()
    least = 1e-9 + 1e-12 * total * np.log(max(total, 2))
    moved = 1
    while moved:
        moved = 0
        for w in range(n):
            a = of[w]
            l, r = left[w].copy(), right[w].copy()
            l[a] -= own[w]
            r[a] -= own[w]
            table[a, :] -= r
            table[:, a] -= l
            table[a, a] -= own[w]
            row, col = table.sum(1) + l, table.sum(0) + r  # of all other words, with their steps to and from this one
            gain = (ent(table + r) - ent(table)).sum(1) + (ent(table + l[:, None]) - ent(table)).sum(0)
            d = np.diag(table)
            gain += ent(d + r + l + own[w]) - ent(d + r) - ent(d + l) + ent(d)
            gain -= ent(row + out_n[w]) - ent(row) + ent(col + in_n[w]) - ent(col)
            b = int(np.argmax(gain[:k]))
            if gain[b] <= gain[a] + least:
                b = a
            table[b, :] += r
            table[:, b] += l
            table[b, b] += own[w]
            if b != a:
                moved += 1
                of[w] = b
                left[:, a] -= pairs[w]
                left[:, b] += pairs[w]
                right[:, a] -= pairs[:, w]
                right[:, b] += pairs[:, w]
    return of[:n]


class Model:
    """What scoring needs besides the counts in the answers; its size is fixed."""

    def __init__(self, top_n: np.ndarray, classes: np.ndarray, kinds: dict[int, tuple[int, int]]):
        self.n = int(top_n.sum()) + sum(t for t, _ in kinds.values())
        self.types = int((top_n > 0).sum()) + sum(v for _, v in kinds.values())
        self.top_n = top_n
        self.top_class = np.append(classes, END).astype(np.int64)
        self.class_n = np.zeros(KINDS)
        np.add.at(self.class_n, self.top_class, top_n)
        for k, (tokens, _) in kinds.items():
            self.class_n[k] += tokens

    def emission(self, count: np.ndarray, kind: np.ndarray, new: float) -> np.ndarray:
        p = count / np.maximum(self.class_n[kind], 1)
        rare = kind == END + 1
        return np.log10(np.where(rare, np.where(count > 0, (1 - new) * p, new), np.maximum(p, 1e-300)))


def _score_blocks(m: Model, new: float):
    def score(t: pa.Table) -> pa.Table:
        col = {c: t.column(c).to_pylist() for c in t.column_names}
        head = next(i for i, b in enumerate(col["bucket"]) if b < 0)
        answers = sorted((col["bucket"][i], i) for i in range(len(col["bucket"])) if col["bucket"][i] >= 0)
        ids, size = np.frombuffer(col["a"][head], "<i8"), np.frombuffer(col["b"][head], "<i8")
        held = np.frombuffer(col["c"][head], bool)
        seq = _from_planes(col["d"][head])
        rest = np.concatenate([np.frombuffer(col["counts"][i], "<u4") for _, i in answers] + [np.empty(0, np.uint32)]).astype(np.int64)
        kinds = np.concatenate([np.frombuffer(col["kinds"][i], np.uint8) for _, i in answers] + [np.empty(0, np.uint8)]).astype(np.int64)
        pad = TOP + 1 - len(m.top_n)
        count = np.concatenate([m.top_n[:-1], np.zeros(pad, np.int64), m.top_n[-1:], rest])
        kind = np.concatenate([m.top_class[:-1], np.zeros(pad, np.int64), m.top_class[-1:], kinds])
        base = np.log10((count + 1) / (m.n + m.types + 1))
        emit = m.emission(count, kind, new)
        start = np.cumsum(size) - size
        sums = [np.add.reduceat(x[seq], start) for x in ((count > 0).astype(np.int64), base, emit)]
        classes = kind[seq].astype(np.uint8).tobytes()
        return pa.table({
            "doc_id": ids_back(ids), "held_out": pa.array(held), "n_tokens": pa.array(size), "n_known": pa.array(sums[0]),
            "base_score": pa.array(sums[1]), "emission": pa.array(sums[2]),
            "classes": pa.array([classes[i : i + n] for i, n in zip(start.tolist(), size.tolist(), strict=True)], pa.binary())})
    return score


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emission double, classes binary"


def _class_pairs(batch):
    col = batch.column(batch.schema.get_field_index("classes")).to_pylist()
    size = np.array([len(c) for c in col])
    seq = np.frombuffer(b"".join(col), np.uint8).astype(np.int64)
    before = np.concatenate([[END], seq[:-1]])  # every text ends with END, so each begins after one
    return before, seq, size


def _transitions(batches):
    table = np.zeros(KINDS * KINDS)
    for b in batches:
        if b.num_rows:
            before, seq, _ = _class_pairs(b)
            table += np.bincount(before * KINDS + seq, minlength=len(table))
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([table.astype("<f8").tobytes()], pa.binary())], ["slice", "values"])


def _final(log_p: np.ndarray):
    def score(batches):
        for b in batches:
            if b.num_rows:
                before, seq, size = _class_pairs(b)
                move = np.add.reduceat(log_p[before, seq], np.cumsum(size) - size)
                col = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
                yield pa.RecordBatch.from_arrays(
                    [*(col[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")), pa.array(col["emission"].to_numpy() + move)],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return score


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    arrow_batches(spark)
    texts = docs.select("doc_id", "text", held_out().alias("held_out"))
    frequent = texts.mapInArrow(_frequent, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = np.array([r["word"] for r in frequent.orderBy(F.desc("n"), "word").limit(TOP).collect()], np.int64).view(np.uint64)
    top = np.sort(top)
    buckets = n_parts(spark)
    blocks = stash(texts.mapInArrow(_blocks(buckets, top), _ROW), "word-blocks", "zstd")
    step = blocks.filter("kind = 2").select(F.pmod(F.xxhash64("block"), F.lit(64)).cast("int").alias("at"), "a", "b", "c")
    step = step.groupBy("at").applyInArrow(_add_pairs("at"), "at int, a binary, b binary, c binary")
    sums = step.withColumn("at", F.lit(0)).groupBy("at").applyInArrow(_add_pairs("at"), "at int, a binary, b binary, c binary").collect()
    pairs, single = np.zeros((TOP + 1, TOP + 1)), np.zeros(TOP + 1, np.int64)
    for r in sums:  # at most (TOP + 1) ** 2 numbers
        pairs.reshape(-1)[np.frombuffer(r["a"], "<i8")] = np.frombuffer(r["b"], "<i8")
        single = np.frombuffer(r["c"], "<i8")
    use = np.append(np.arange(len(top)), TOP)
    classes = exchange(pairs[np.ix_(use, use)], CLASSES)
    hot = np.eye(CLASSES + 1)[np.append(classes, END)]
    edges = hot.T @ pairs[np.ix_(use, use)] @ hot
    known = blocks.filter("kind = 0").select("block", "b", "c", "d", "cuts").mapInArrow(
        _contexts(np.append(classes, np.full(TOP - len(classes), END))), "block long, bucket int, per binary, slot binary, n binary")
    words = blocks.filter("kind = 1").select("block", "bucket", "a", "b").unionByName(known, allowMissingColumns=True)
    answers = stash(words.groupBy("bucket").applyInArrow(
        _totals(edges), "block long, bucket int, counts binary, kinds binary, kind int, tokens long, types long"), "word-counts", "zstd")
    kinds = {r["kind"]: (r["tokens"], r["types"]) for r in answers.filter("block is null").groupBy("kind").agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect()}  # at most KINDS rows
    model = Model(single[use], classes, kinds)
    # of rare held-out tokens, the part that is new: words seen once would each have been new, those seen twice not
    once = kinds.get(END + 1, (0, 0))[0]
    twice = kinds.get(END + 2, (0, 0))[1]
    new = once / (once + 2.0 * twice) if once else 1.0
    new = min(max(new, 0.05), 0.95) if once else 1.0
    mail = blocks.filter("kind = 0").select("block", "bucket", "a", "b", "c", "d", F.lit(None).cast("binary").alias("counts"), F.lit(None).cast("binary").alias("kinds"))
    mail = mail.unionByName(answers.filter("block is not null").select("block", "bucket", "counts", "kinds"), allowMissingColumns=True)
    scored = stash(mail.groupBy("block").applyInArrow(_score_blocks(model, new), _SCORED), "class-sequences", "zstd")
    moves = add_slices(scored.filter("not held_out").select("classes").mapInArrow(_transitions, "slice int, values binary"), "<f8")
    table = moves[0].reshape(KINDS, KINDS) if 0 in moves else np.zeros((KINDS, KINDS))
    total = table.sum(0) + 0.5
    prior = total / total.sum()
    log_p = np.log10((table + SMOOTH * prior) / (table.sum(1, keepdims=True) + SMOOTH))
    out = scored.mapInArrow(_final(log_p), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(model.n).cast("long"))


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))
