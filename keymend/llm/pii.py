"""Personal data by weak supervision (DataFrame functions only).

Base spans of four kinds (e-mail, IP, card, phone) come from patterns and checks and always stay.
Further candidates come from wider patterns: written-out e-mail addresses, phone numbers without a country
code, social-security numbers, and long hexadecimal secrets. Every candidate, base ones included,
gets the votes (1, 0 or none) of six labelers:

  form      regex: a strict form of the kind
  check     regex: digits or letters that are plausible (length, not all equal)
  gazetteer the span's own value is in a list (top-level domains, dialling codes, card issuers, digest
            lengths: for; reserved networks, toll-free codes: against)
  cue       a contact word stands just before
  context   a word that speaks against it (order, page, version, ...) stands just before
  delimited stands alone between white space or punctuation

and features of the span: its length, the share of digits, and what stands on either side. Spans take finitely many
patterns of votes and features (CELLS at most), so only their counts go to the driver, whatever the input. There
expectation-maximisation over the votes estimates each labeler's reliability and each span's probability
(Dawid-Skene with two classes), and a logistic span classifier over votes, features and kind is trained on
these. Its decisions go back as a literal map; a wider candidate is added if its probability is at least ADD and it
overlaps no base span.

Cases: null and empty texts have no spans; equal and overlapping spans of different kinds all stay among base
kinds; repeated rows each get a row; empty tables give empty results; extra input columns are
ignored. Patterns never backtrack over long runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.llm.common import documents, stash

KINDS = ("email", "ip", "card", "phone")
ADD = 0.9
ROUNDS = 30
#: Most patterns that can occur: eight kinds, six votes of three values, features of four and three values each.
CELLS = 8 * 3**6 * 4**2 * 3**2
#: Outputs that are gathered at once in a running pass over an array.
BLOCK = 128

# Base patterns. Possessive and anchored forms of the plain ones, with the same leftmost matches:
# a run of local-part characters is tried once, at its start or right after a match. A chain of digits is
# matched whole or, with under 14 digits, not at all: no place inside it has more of them.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Wider patterns, and the strict form of each.
WIDE = {
    "email_spelled": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{2,64}+ ?(?:\[dot\]|\(dot\)|\.) ?[a-z]{2,10}+",
    "phone_local": r"(?<![0-9+().-])(?<!\+[0-9] )(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,128}+(?![A-Za-z0-9])",
}
STRICT = {
    "email_spelled": r"(?:\[dot\]|\(dot\))", "phone_local": r"^\(", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)",
    "secret": r"^(?=.*[a-f])(?=.*[0-9])",
}

# Words before a span that speak for or against personal data.
FOR = "mail email contact phone tel call mobile fax card visa address host ip ssn social token key secret password api reach"
AGAINST = "order page version isbn issue item part no id ref build section figure table chapter model"


# Of the gazetteers, by kind: values of personal data, and values that are none.
_DOMAINS = "com org net edu gov info io co de fr es it nl uk eu us ca"
_DIAL = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
LISTED = {
    "email": r"\.(?:" + "|".join(_DOMAINS.split()) + ")$", "email_spelled": r"(?:" + "|".join(_DOMAINS.split()) + ")$",
    "phone": r"^\+(?:" + "|".join(_DIAL.split()) + ")", "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)",
    "secret": r"^(?:.{32}|.{40}|.{56}|.{64}|.{96}|.{128})$",
}
UNLISTED = {
    "ip": r"^(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|^192\.168\.|^169\.254\.", "phone_local": r"^\(?(?:800|888|877|866|900)",
    "ssn": r"^(?:000|666|9)", "email": r"@(?:localhost|test|invalid)\.",
}


def _let(x: Column, use) -> Column:
    """`use` of a value that is worked out once, however often `use` names it."""
    return F.transform(F.array(x), use)[0]


def _scan(items: Column, zero: Column, made: str, step) -> Column:
    """One output of type `made` per item: step(state, item) gives the next state `at` and the output `one`.
    Outputs gather in blocks, since an array that grows item by item is copied each time: n items
    cost n * BLOCK + (n / BLOCK)**2 copied references."""
    none, blocks = F.expr(f"cast(array() as array<{made}>)"), F.expr(f"cast(array() as array<array<{made}>>)")
    grown = lambda acc, at, one: F.struct(at.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def item(acc, x):
        return _let(step(acc["at"], x), lambda r: grown(acc, r["at"], r["one"]))

    def run(every):
        def block(acc, b):
            part = F.slice(every, b * BLOCK + 1, F.lit(BLOCK))
            return _let(F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), item), lambda r: grown(acc, r["at"], r["out"]))

        last = F.floor((F.size(every) - 1) / BLOCK).cast("int")
        out = F.aggregate(F.sequence(F.lit(0), last), F.struct(zero.alias("at"), blocks.alias("out")), block, lambda acc: F.flatten(acc["out"]))
        return F.when(F.size(every) > 0, out).otherwise(none)

    return _let(items, run)


def _matches(text: Column, pattern: str, needs: str | None) -> Column:
    """start, end (code points, end exclusive), match and the 24 characters before, of every
    leftmost non-overlapping match."""
    made = "struct<start:int,end:int,hit:string,before:string,after:string>"

    def placed(at, x):
        start, end = at + x["skip"], at + x["skip"] + x["long"]
        return F.struct(end.alias("at"), F.struct(start.alias("start"), end.alias("end"), x["hit"], x["before"], x["after"]).alias("one"))

    def found(hits):
        between = lambda parts: F.transform(hits, lambda h, i: F.struct(
            F.char_length(parts[i]).alias("skip"), F.char_length(h).alias("long"), h.alias("hit"),
            F.right(parts[i], F.lit(24)).alias("before"), F.left(parts[i + 1], F.lit(1)).alias("after")))
        return F.when(F.size(hits) > 0, _scan(_let(F.split(text, pattern, -1), between), F.lit(0), made, placed))

    seen = text.rlike("[0-9]") if needs is None else F.contains(text, F.lit(needs))
    spans = F.when(seen, _let(F.regexp_extract_all(text, F.lit(pattern), 0), found))
    return F.coalesce(spans, F.expr(f"cast(array() as array<{made}>)"))


def _free(base: Column, wide: Column) -> Column:
    """The wide spans that overlap no base span, by one sweep from either end."""
    made = "struct<start:int,end:int,wide:int,kind:string,free:boolean>"

    def marked(spans, w):
        return F.transform(spans, lambda s: F.struct(s["start"], s["end"], F.lit(w).alias("wide"), s["kind"], F.lit(True).alias("free")))

    def sweep(items, zero, state, clear):
        return _scan(items, zero, made, lambda at, x: F.struct(
            F.when(x["wide"] == 0, state(at, x)).otherwise(at).alias("at"),
            F.struct(x["start"], x["end"], x["wide"], x["kind"], (x["free"] & clear(at, x)).alias("free")).alias("one")))

    ahead = sweep(F.array_sort(F.concat(marked(base, 0), marked(wide, 1))), F.lit(0), lambda at, x: F.greatest(at, x["end"]), lambda at, x: at <= x["start"])
    back = sweep(F.reverse(ahead), F.lit(2**31 - 1), lambda at, x: F.least(at, x["start"]), lambda at, x: at >= x["end"])
    kept = F.transform(F.filter(back, lambda s: (s["wide"] == 1) & s["free"]), lambda s: F.struct(s["start"], s["end"], s["kind"]))
    return F.when(F.size(wide) > 0, kept).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _checked(kind: str, spans: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.regexp_replace(p, "^0+", "")
        ok = lambda s: F.forall(F.split(s["hit"], r"\."), lambda p: (F.char_length(bare(p)) <= 3) & (F.lpad(bare(p), 3, "0") <= "255"))
        return F.filter(spans, ok)
    if kind == "card":
        return F.filter(spans, lambda s: F.char_length(_digits(s["hit"])).between(14, 19) & F.call_function("luhn_check", _digits(s["hit"])))
    if kind == "phone":
        return F.filter(spans, lambda s: F.char_length(_digits(s["hit"])).between(10, 15))
    return spans


def _votes(kind: str, s: Column) -> Column:
    """The six votes as characters 1, 0 and - (none), a bar, and the four features of the span."""
    before = F.lower(s["before"])
    said = lambda words: before.rlike(r"(?<![a-z])(?:" + "|".join(words.split()) + r")[a-z]{0,2}[\W_]{0,6}$")
    form = F.lit("1") if kind in KINDS else F.when(s["hit"].rlike(STRICT[kind]), "1").otherwise("-")
    bare = F.regexp_replace(s["hit"], r"\W", "")
    equal = (bare != "") & (F.replace(bare, F.left(bare, F.lit(1)), F.lit("")) == "")
    plausible = F.when(equal, "0").when(F.char_length(s["hit"]) >= 7, "1").otherwise("-")
    never = F.lit(False)
    listed = (F.when(s["hit"].rlike(UNLISTED[kind]) if kind in UNLISTED else never, "0")
              .when(F.lower(s["hit"]).rlike(LISTED[kind]) if kind in LISTED else never, "1").otherwise("-"))
    last, after = F.right(s["before"], F.lit(1)), F.coalesce(s["after"], F.lit(""))
    alone = last.rlike(r"^[\s\"'(<\[:=]?$") & after.rlike(r"^[\s\"')>\],.;!?]?$")
    n, digits = F.char_length(s["hit"]), F.char_length(_digits(s["hit"]))
    size = F.when(n <= 8, "a").when(n <= 16, "b").when(n <= 31, "c").otherwise("d")
    share = F.when(digits == 0, "e").when(digits * 2 < n, "f").when(digits < n, "g").otherwise("h")
    side = lambda c, names: F.when(c.rlike(r"^\s?$"), names[0]).when(c.rlike(r"^\w$"), names[1]).otherwise(names[2])
    return F.concat(form, plausible, listed, F.when(said(FOR), "1").otherwise("-"), F.when(said(AGAINST), "0").otherwise("-"),
                    F.when(alone, "1").otherwise("0"), F.lit("|"), size, share, side(last, "ijk"), side(after, "lmn"))


def reliabilities(cells: dict[tuple[str, str], int], rounds: int = ROUNDS) -> dict[tuple[str, str], float]:
    """Expectation-maximisation over (kind, votes) -> count: probability that such a span is
    personal data. Each labeler has the chance of each vote in either class; kinds share labelers
    and have shares of their own. Features (after a bar) play no part."""
    if not cells:
        return {}
    whole, cells = cells, {}
    for (kind, code), count in whole.items():
        key = kind, code.split("|")[0]
        cells[key] = cells.get(key, 0) + count
    vote = lambda v: {"1": 2, "0": 1, "-": 0}[v]
    n = len(next(iter(cells))[1])
    post = {k: min(0.95, max(0.05, 0.5 + 0.15 * (k[1].count("1") - 2 * k[1].count("0") - 1))) for k in cells}
    for _ in range(rounds):
        table = [[[1.0 + 2.0 * (c == 1 and v == 2) + 2.0 * (c == 0 and v == 1) for v in range(3)] for _ in range(n)] for c in range(2)]
        share = {kind: [1.0, 1.0] for kind, _ in cells}
        for (kind, votes), count in cells.items():
            p = post[kind, votes]
            for c, w in ((0, (1 - p) * count), (1, p * count)):
                share[kind][c] += w
                for j, v in enumerate(votes):
                    table[c][j][vote(v)] += w
        for kind, votes in cells:
            score = [math.log(share[kind][c]) + sum(math.log(table[c][j][vote(v)] / sum(table[c][j])) for j, v in enumerate(votes)) for c in range(2)]
            post[kind, votes] = 1 / (1 + math.exp(max(-500, min(500, score[0] - score[1]))))
    return {(kind, code): post[kind, code.split("|")[0]] for kind, code in whole}


def classifier(cells: dict[tuple[str, str], int], soft: dict[tuple[str, str], float], steps: int = 400) -> dict[tuple[str, str], float]:
    """Logistic span classifier over votes, features and kind, trained on the cells with their soft labels;
    returns its probability for each cell."""
    if not cells:
        return {}
    names = sorted({f for k, v in cells for f in (f"kind={k}", *(f"{j}={c}" for j, c in enumerate(v)))})
    at = {f: i for i, f in enumerate(names)}
    rows = [([at[f"kind={k}"], *(at[f"{j}={c}"] for j, c in enumerate(v))], n, soft[k, v]) for (k, v), n in cells.items()]
    total, w, grad2 = sum(n for _, n, _ in rows), [0.0] * len(names), [1e-8] * len(names)

    def prob(f):
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, sum(w[i] for i in f)))))

    for _ in range(steps):
        g = [1e-4 * x for x in w]
        for f, n, y in rows:
            e = (prob(f) - y) * n / total
            for i in f:
                g[i] += e
        for i, x in enumerate(g):
            grad2[i] += x * x
            w[i] -= 0.5 * x / math.sqrt(grad2[i])
    return {k: prob(f) for k, (f, _, _) in zip(cells, rows, strict=True)}


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans, n_added and n_spans for every row of `docs` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def marked(kind, spans):
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), _votes(kind, s).alias("votes")))

    base = {k: marked(k, _checked(k, _matches(text, PATTERNS[k], NEEDS[k]))).alias(k) for k in KINDS}
    hints = {"email_spelled": "at", "phone_local": None, "ssn": "-", "secret": None}
    wide = {k: marked(k, _matches(text, p, hints[k])).alias(k) for k, p in WIDE.items()}
    rows = stash(docs.select("doc_id", *base.values(), F.concat(*wide.values()).alias("wide")), "pii-spans")
    each = rows.select(F.explode(F.concat(*KINDS, "wide")).alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    cells = {(r["kind"], r["votes"]): r["n"] for r in each.orderBy("kind", "votes").collect()}  # at most CELLS rows
    judged = classifier(cells, reliabilities(cells))
    good = [f"{k}|{v}" for (k, v), p in judged.items() if p >= ADD and k in WIDE]
    base_spans = F.concat(*KINDS)
    rank = lambda s: F.array_position(F.array(*map(F.lit, (*KINDS, *WIDE))), s["kind"])
    joined = lambda a: F.array_join(F.transform(
        F.array_sort(F.transform(a, lambda s: F.struct(s["start"].alias("a"), rank(s).alias("b"), s["end"].alias("c"), s["kind"].alias("d")))),
        lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")
    accepted = F.filter("wide", lambda s: F.concat_ws("|", s["kind"], s["votes"]).isin(good))
    plain = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["end"], s["kind"]))
    added = rows.withColumn("base", plain(base_spans)).withColumn("added", _let(accepted, lambda w: _free(F.col("base"), w)))
    return added.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"), (F.size("base") + F.size("added")).cast("long").alias("n_spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))
