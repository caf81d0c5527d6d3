"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(b):
    return hashlib.sha256(b).hexdigest()


def substring(docs):
    seen, out = set(), {}
    for d, t in sorted(docs):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            if k in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(k)
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def suffix(docs, length=400):
    raw = {d: (t or "").encode() for d, t in docs}
    count = Counter(b[i : i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw.items():
        mask, end = [], 0
        for i in range(len(b)):
            if i + length <= len(b) and count[b[i : i + length]] > 1:
                end = i + length
            mask.append(i < end)
        spans = sum(m and (not i or not mask[i - 1]) for i, m in enumerate(mask))
        out[d] = (len(b), sum(mask), spans, sha(bytes(x for x, m in zip(b, mask) if not m)))
    return out


def near(docs):
    sets = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(tri)
    cover = {i + j for i, x in enumerate(tri) if c[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def pii(t):
    found = sorted((m.start(), r, m.end(), k) for r, (k, p) in enumerate(PII.items()) for m in re.finditer(p, t or "") if _good(k, m.group()))
    return (*(sum(x[1] == r for x in found) for r in range(4)), sha(",".join(f"{k}:{a}:{e}" for a, _, e, k in found).encode()))


def unigrams(docs):
    import math

    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    tokens = {d: [*WORD.findall((t or "").translate(LOWER)), "\0"] for d, t in docs}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (held[d], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in tokens.items()}


def exact(docs):
    norm = {d: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for d, t in docs}
    group = defaultdict(list)
    for d, t in norm.items():
        group[t].append(d)
    return {d: (min(group[t]), len(group[t]), d == min(group[t]), sha(t.encode())) for d, t in norm.items()}
