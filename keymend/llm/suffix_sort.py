"""Two-stage suffix sorting of a byte text, in numpy, and its adjacent common prefixes.

A suffix is of type S when it is smaller than the suffix that starts one byte later, else of
type L. Stage one sorts the S suffixes alone, by their first `depth` bytes, eight bytes at a
time, looking further only where suffixes are still tied. Stage two induces the L suffixes: the
buckets (by first byte) are scanned in order, and every scanned suffix puts the suffix one
byte before it, if that is of type L, at the next free place of its bucket. Within a bucket
L suffixes come before S suffixes, so a scan never meets a place that is still to be filled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PAD = 16


def _words_at(text: np.ndarray) -> np.ndarray:
    """Unaligned view: the eight bytes from each position, as a big-endian number."""
    return np.ndarray((len(text) - 8,), ">u8", text.data, 0, (1,))


def is_s_type(text: np.ndarray) -> np.ndarray:
    n = len(text)
    differ = np.flatnonzero(text[:-1] != text[1:])
    nxt = np.searchsorted(differ, np.arange(n))
    out = np.ones(n, bool)  # the run of equal bytes at the end counts as smaller
    inside = nxt < len(differ)
    at = differ[nxt[inside]]
    out[inside] = text[at] < text[at + 1]
    return out


def _sort_direct(view: np.ndarray, pos: np.ndarray, depth: int) -> np.ndarray:
    """`pos` by the first `depth` bytes of their suffixes; ties keep any order."""
    key = view[pos].astype(np.uint64)
    order = np.argsort(key)
    pos, key = pos[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(pos) else np.empty(0, bool)
    group = np.cumsum(new) - 1
    at = np.arange(len(pos))  # the places that are still tied
    for d in range(8, depth, 8):
        size = np.bincount(group)
        tied = size[group] > 1
        at, group = at[tied], group[tied]
        if not len(at):
            break
        key = view[np.minimum(pos[at] + d, len(view) - 1)].astype(np.uint64)
        same = group[1:] == group[:-1]
        step = np.concatenate([[True], ~same | (key[1:] != key[:-1])])
        mixed = np.zeros(int(group.max()) + 1, bool)
        mixed[group[1:][same & step[1:]]] = True
        todo = np.flatnonzero(mixed[group])
        if len(todo):
            by = todo[np.lexsort((key[todo], group[todo]))]
            pos[at[todo]] = pos[at[by]]
            key[todo] = key[by]
            step = np.concatenate([[True], ~same | (key[1:] != key[:-1])])
        group = np.cumsum(step) - 1
    return pos


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of `text` (bytes, 0 only as a separator) in the order of their suffixes' first
    `depth` bytes at least."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + PAD, np.uint8)])
    s_type = is_s_type(text)
    stage_one = _sort_direct(_words_at(padded), np.flatnonzero(s_type), depth)
    size = np.bincount(text, minlength=256)
    begin = np.cumsum(size) - size
    s_size = np.bincount(text[stage_one], minlength=256)
    sa = np.empty(n, np.int64)
    s_from = begin + size - s_size
    s_order = np.concatenate([[0], np.cumsum(s_size)])
    head = begin.copy()
    for c in range(256):
        if not size[c]:
            continue
        sa[s_from[c] : begin[c] + size[c]] = stage_one[s_order[c] : s_order[c + 1]]
        found, low = [], begin[c]
        while low < head[c]:  # L suffixes of this bucket; runs of the same byte add to it while it is scanned
            scanned = sa[low : head[c]]
            low = head[c]
            before = scanned[scanned > 0] - 1
            before = before[~s_type[before]]
            own = text[before] == c
            found.append(before[~own])
            sa[low : low + int(own.sum())] = before[own]
            head[c] += int(own.sum())
        scanned = sa[s_from[c] : begin[c] + size[c]]
        before = scanned[scanned > 0] - 1
        found.append(before[~s_type[before]])
        before = np.concatenate(found)
        to = text[before]
        order = np.argsort(to, kind="stable")
        before, to = before[order], to[order]
        per = np.bincount(to, minlength=256)
        place = head[to] + np.arange(len(to)) - (np.cumsum(per) - per)[to]
        sa[place] = before
        head += per
    return sa


def adjacent_prefix_at_least(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours order[i], order[i + 1]: whether their first `length` bytes are equal."""
    view = _words_at(np.concatenate([text, np.zeros(length + PAD, np.uint8)]))
    alive = np.arange(max(len(order) - 1, 0))
    steps = [*range(0, length - 8, 8), length - 8] if length >= 8 else []
    for d in steps:
        alive = alive[view[order[alive] + d] == view[order[alive + 1] + d]]
        if not len(alive):
            break
    out = np.zeros(max(len(order) - 1, 0), bool)
    out[alive] = True
    return out
