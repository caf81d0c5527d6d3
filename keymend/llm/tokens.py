"""Byte-level BPE of whole chunks: the pieces that the tokenizer's pattern cuts are found by
array operations, each distinct piece is encoded once, and ids are gathered by piece.

Only texts of code points below LATIN take this way, where the classes of the pattern are
beyond doubt; others go through the tokenizers library as they are."""

from __future__ import annotations

import base64
import re
import unicodedata

import numpy as np

from keymend.llm.common import mix, powers, ragged

LATIN = 0x250
#: Distinct pieces remembered by a worker before it starts afresh.
REMEMBER = 300_000

_LETTER, _NUMBER, _SPACE, _OTHER, _ODD = 1, 2, 3, 0, 9


def _classes() -> np.ndarray:
    t = np.zeros(LATIN, np.int8)
    for i in range(LATIN):
        kind = unicodedata.category(chr(i))
        t[i] = _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else _ODD if kind in ("Cc", "Cn") else _OTHER
    t[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
    return t


_CLASS = _classes()
_HASH = np.random.Generator(np.random.PCG64(99)).integers(1, 2**63, LATIN, dtype=np.uint64)
_SPECIAL = re.compile(r"<\|\w+\|>")


def piece_starts(cp: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of the pattern's pieces in code points `cp` of documents with offsets `off`."""
    n = len(cp)
    kind = _CLASS[cp]
    full = off[1:] > off[:-1]
    first = np.zeros(n + 1, bool)
    first[off[:-1][full]] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run.copy()
    at = np.flatnonzero(run)
    begin, end = at[:-1], at[1:]
    # white space before something else in the same document: its last character stands apart
    lead = (kind[begin] == _SPACE) & ~first[end]
    last = end[lead] - 1
    start[last] = True
    start[end[lead][cp[last] == 32]] = False  # and a space goes with what follows
    # 's 't 're 've 'm 'll 'd at the start of a piece
    q = begin[(cp[begin] == 39) & (end - begin == 1) & ~first[end]]
    q = q[start[q] & (kind[q + 1] == _LETTER)]
    if len(q):
        a = cp[q + 1]
        two = (q + 2 < n) & ~first[np.minimum(q + 2, n)]
        b = np.where(two, cp[np.minimum(q + 2, n - 1)], 0)
        short = np.isin(a, [ord(x) for x in "stmd"])
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for use, size in ((short, 1), (long, 2)):
            start[q[use] + 1] = False
            start[q[use] + 1 + size] = True
    return np.flatnonzero(start[:n])


class Encoder:
    """Ids below 65536 of the tokenizer file at `path` (its ranks stand beside it)."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.piece = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.known: dict[int, bytes] = {}

    def encode(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Ids of each document of a chunk of UTF-8."""
        raw = data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(off[:-1], off[1:], strict=True)]
        plain, odd = [], []
        for i, t in enumerate(texts):
            (odd if _SPECIAL.search(t) else plain).append(i)
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        cps = [np.frombuffer(texts[i].encode("utf-32-le"), "<u4") for i in plain]
        keep = []
        for i, c in zip(plain, cps, strict=True):
            ok = not len(c) or (int(c.max()) < LATIN and not (_CLASS[c] == _ODD).any())
            (keep if ok else odd).append((i, c) if ok else i)
        if keep:
            for (i, _), ids in zip(keep, self._encode_plain([c for _, c in keep]), strict=True):
                out[i] = ids
        for i in odd:
            out[i] = np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

    def _encode_plain(self, docs: list[np.ndarray]) -> list[np.ndarray]:
        size = np.array([len(c) for c in docs])
        off = np.concatenate([[0], np.cumsum(size)])
        cp = np.concatenate(docs).astype(np.int64)
        if not len(cp):
            return [np.empty(0, np.uint32) for _ in docs]
        start = piece_starts(cp, off)
        end = np.append(start[1:], len(cp))
        power, inverse = powers(len(cp) + 1)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_HASH[cp] * power[: len(cp)])])
        h = mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))
        own, first, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBER:
            self.known.clear()
        known = self.known
        parts = [known.get(k) for k in own.tolist()]
        missing = [i for i, p in enumerate(parts) if p is None]
        if missing:
            text = cp.astype("<u4").tobytes().decode("utf-32-le")
            a, b = start[first].tolist(), end[first].tolist()
            for i in missing:
                parts[i] = known[int(own[i])] = np.array(self.piece(text[a[i] : b[i]]), "<u2").tobytes()
        ids = np.frombuffer(b"".join(parts), "<u2")
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 2
        at = np.cumsum(length) - length
        flat = ids[ragged(at[which], length[which])].astype(np.uint32)
        cuts = np.concatenate([[0], np.cumsum(length[which])])[np.searchsorted(start, off)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
