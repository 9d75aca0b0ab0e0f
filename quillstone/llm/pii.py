"""Personal data by weak supervision, in DataFrame functions only.

Base spans come from four fixed patterns with checks. Around them lie candidates: strings of a base
pattern that fail its check, and wider forms (obfuscated addresses, numbers without a plus, ...).
Three labelers vote on every candidate: the pattern, a gazetteer, and the words before it.
Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability by
kind; its posteriors weigh a naive Bayes classifier over features of the span, which decides which
candidates join the base spans.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import drop_scratch, write_scratch

KINDS = ("email", "ip", "card", "phone")

# The base patterns as the contract gives them, written so that the engine neither
# recurses nor backtracks. A match starts where no character of its own first class stands before
# it or where the last match ended; card takes whole runs of 16 to 19 digits, since shorter and
# longer ones are dropped anyway.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these can't match.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+])(?<![0-9][\x20.-])(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[2-9][0-9]{2}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])",
}
WIDE_HINT = {"email": r"[(\[](?:at|AT)[)\]]", "ip": ":[0-9A-Fa-f]{1,4}:", "card": "3[47][0-9]{2}", "phone": r"[0-9]{3}[)\x20.-]"}
#: Gazetteers: top-level domains; first digits of card issuers; first octets that are no public host; country codes.
GAZETTEER = {
    "email": r"(?i)[.\]) ](com|org|net|edu|gov|mil|info|io|de|fr|es|it|uk|eu|ch|at|nl|be|ca|us|mx|ar|br|au)$",
    "ip": r"^(?!0*(?:0|10|127|22[4-9]|2[3-5][0-9])\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-4]|36|39|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|[(2-9])",
}
FOR = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|kontakt|correo|courriel|adresse?)\b",
    "ip": r"(?i)\b(ip|host|server|address|client|login|adresse|servidor|serveur)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|payment|account|karte|konto|carte|tarjeta|cuenta)\b",
    "phone": r"(?i)\b(phone|tel|call|mobile|cell|fax|telefon|anruf|appel|llame|tel[eé]fono|t[eé]l[eé]phone)\b",
}
AGAINST = r"(?i)\b(version|isbn|issn|order|serial|ticket|invoice|id|ref|sku|build|section|page)\b"
#: Characters before a span that the context labeler reads.
CONTEXT = 40
#: No match is shorter than four characters, so the context of one ends within so many matches before it.
REACH = CONTEXT // 4
ROUNDS = 10
#: Steps of a search by halves among the spans of a text; an array holds less than 2**31.
HALVINGS = 31


def _none() -> Column:
    return F.array().cast("array<struct<lo:int,hi:int,s:string,before:string>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body's own lambdas read it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _found(text: Column, pattern: str, hint: str) -> Column:
    """All matches of a pattern: start and end in code points, the match, and the CONTEXT characters before it.

    Lengths of matches and of what lies between are summed up within blocks of as many matches as there
    are blocks, so that n matches cost n times the root of n; no text is walked again for a match.
    """
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda g, m: F.struct(
            F.length(g).alias("gap"),
            F.length(m).alias("len"),
            m.alias("s"),
            F.right(g, F.lit(CONTEXT)).alias("near"),
            F.right(F.concat(g, m), F.lit(CONTEXT)).alias("tail"),
        ),
    )

    def block(at: Column, part: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            lo = acc["at"] + x["gap"]
            hi = lo + x["len"]
            one = F.struct(lo.alias("lo"), hi.alias("hi"), x["s"].alias("s"), x["before"].alias("before"))
            return F.struct(hi.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(part, F.struct(at.alias("at"), _none().alias("out")), step, lambda acc: acc["out"])

    def placed(p: Column) -> Column:
        def before(x: Column, i: Column) -> Column:
            last = F.slice(p, F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH)))
            told = F.concat(F.array_join(F.transform(last, lambda y: y["tail"]), ""), x["near"])
            return F.struct(x["gap"].alias("gap"), x["len"].alias("len"), x["s"].alias("s"), F.right(told, F.lit(CONTEXT)).alias("before"))

        def joined(q: Column) -> Column:
            size = F.ceil(F.sqrt(F.size(q))).cast("int")
            parts = F.transform(F.sequence(F.lit(1), F.size(q), size), lambda i: F.slice(q, i, size))
            return _let(parts, summed)

        def summed(parts: Column) -> Column:
            lengths = F.transform(parts, lambda x: F.aggregate(x, F.lit(0), lambda acc, y: acc + y["gap"] + y["len"]))
            starts = F.aggregate(lengths, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
            return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), lambda part, at: block(at, part)))

        return F.when(F.size(p) == 0, _none()).otherwise(_let(F.transform(p, before), joined))

    hinted = text.contains(hint) if hint == "@" else text.rlike(hint)
    return F.when(hinted, _let(F.filter(pairs, lambda x: x["s"].isNotNull()), placed)).otherwise(_none())


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # no part above 255, whatever zeros it begins with
        return ~s.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    digits = F.regexp_replace(s, "[^0-9]", "")
    n = F.length(digits)
    return n.between(8, 15) if kind == "phone" else n.between(16, 19) & _luhn(digits)


def _candidates(text: Column) -> Column:
    """All base matches and wide forms: kind, lo, hi, form (0 base, 1 failed its check, 2 wide), the votes and features."""
    parts = []
    for k, kind in enumerate(KINDS):
        parts.append(F.transform(_found(text, BASE[kind], HINT[kind]), _described(kind, k, True)))
        parts.append(F.transform(_found(text, WIDE[kind], WIDE_HINT[kind]), _described(kind, k, False)))
    return F.concat(*parts)


def _described(kind: str, k: int, base: bool) -> Callable[[Column], Column]:
    def one(x: Column) -> Column:
        s, before = x["s"], x["before"]
        digits = F.regexp_replace(s, "[^0-9]", "")
        valid = _valid(kind, s) if base else F.lit(True)
        context = F.when(before.rlike(FOR[kind]), 1).when(before.rlike(AGAINST), -1).otherwise(0)
        subject = F.regexp_replace(s, r"[\x20-]", "") if kind == "card" else s
        known = F.when(subject.rlike(GAZETTEER[kind]), 1).otherwise(-1)
        plain = _luhn(digits) if kind == "card" else ~s.rlike("[0-9]{5}")
        return F.struct(
            F.lit(k).alias("kind"),
            x["lo"].alias("lo"),
            x["hi"].alias("hi"),
            (F.when(valid, 0).otherwise(1) if base else F.lit(2)).alias("form"),
            (F.when(valid, 1).otherwise(-1) if base else F.lit(0)).alias("v0"),
            known.alias("v1"),
            context.alias("v2"),
            (known > 0).cast("int").alias("f0"),
            (context > 0).cast("int").alias("f1"),
            (context < 0).cast("int").alias("f2"),
            (F.length(digits) >= 10).cast("int").alias("f3"),
            s.rlike(r"[\x20()\[\]-]").cast("int").alias("f4"),
            plain.cast("int").alias("f5"),
        )

    return one


FEATURES = tuple(f"f{i}" for i in range(6))
VOTES = ("v0", "v1", "v2")


def _by_kind(values: list[float], kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), kind + 1)


def _fit(patterns: DataFrame) -> list[list[float]]:
    """Weights of the span classifier for each kind: the bias, then for each feature that of 0 and of 1.

    patterns has a row with its count n for each combination of kind, votes and features, of which
    there are a few thousand at most; only sums by kind leave it.
    """
    kinds = range(len(KINDS))
    prior, right, wrong = [0.5] * len(KINDS), [[0.8] * len(KINDS) for _ in VOTES], [[0.8] * len(KINDS) for _ in VOTES]
    kind = F.col("kind")

    def posterior() -> Column:
        logit = _by_kind([math.log(p / (1 - p)) for p in prior], kind)
        for v, a, b in zip(VOTES, right, wrong):
            yes = _by_kind([math.log(a[k] / (1 - b[k])) for k in kinds], kind)
            no = _by_kind([math.log((1 - a[k]) / b[k]) for k in kinds], kind)
            logit = logit + F.when(F.col(v) == 1, yes).when(F.col(v) == -1, no).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))

    def sums(*wanted: Column) -> dict[int, tuple]:
        weighed = patterns.withColumn("p", posterior())
        return {r[0]: r for r in weighed.groupBy("kind").agg(*[F.sum(x) for x in wanted]).collect()}

    p, n = F.col("p"), F.col("n")
    for _ in range(ROUNDS):
        wanted = [n * p, n]
        for v in VOTES:
            c = F.col(v)
            wanted += [F.when(c == 1, n * p).otherwise(0), F.when(c != 0, n * p).otherwise(0)]
            wanted += [F.when(c == -1, n * (1 - p)).otherwise(0), F.when(c != 0, n * (1 - p)).otherwise(0)]
        for k, row in sums(*wanted).items():
            prior[k] = (row[1] + 1) / (row[2] + 2)
            for j in range(len(VOTES)):
                hit, of, miss, off = row[3 + 4 * j : 7 + 4 * j]
                # a labeler is taken to be better than chance
                right[j][k] = min(0.99, max(0.5, (hit + 4) / (of + 5)))
                wrong[j][k] = min(0.99, max(0.5, (miss + 4) / (off + 5)))
    wanted = [n * p, n]
    for f in FEATURES:
        wanted += [F.when(F.col(f) == 1, n * p).otherwise(0), F.when(F.col(f) == 1, n * (1 - p)).otherwise(0)]
    got, weights = sums(*wanted), []
    for k in kinds:
        row = got.get(k) or (k, *[0.0] * len(wanted))
        yes, no = row[1], row[2] - row[1]
        own = [math.log((yes + 1) / (no + 1))]
        for j in range(len(FEATURES)):
            a, b = (row[3 + 2 * j] + 1) / (yes + 2), (row[4 + 2 * j] + 1) / (no + 2)
            own += [math.log((1 - a) / (1 - b)), math.log(a / b)]
        weights.append(own)
    return weights


def _overlaps(base: Column, x: Column) -> Column:
    """Whether x overlaps one of the spans in base, which lie apart and in order: the last one that starts before x ends tells."""

    def halve(acc: Column, _: Column) -> Column:
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        below = F.get(base, mid)["lo"] < x["hi"]
        lo = F.when((acc["lo"] < acc["hi"]) & below, mid + 1).otherwise(acc["lo"])
        hi = F.when((acc["lo"] < acc["hi"]) & ~below, mid).otherwise(acc["hi"])
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    ends = F.struct(F.lit(0).alias("lo"), F.size(base).alias("hi"))
    first = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), ends, halve, lambda acc: acc["lo"])
    return F.coalesce(F.get(base, first - 1)["hi"] > x["lo"], F.lit(False))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and base_sha256 are of the base spans (see BASE and the checks); spans lists these and
    the candidates that the classifier accepts and that overlap no base span of their kind, as
    kind:start:end in code points, by kind and start, joined by commas. Null text is empty, and a text
    without spans has an empty list. Repeated rows each get their row; other columns are ignored.

    Both passes read every text and need no shuffle but that of the pattern counts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", _candidates(F.col("text")).alias("found"))
    seen = rows.select(F.explode("found").alias("x"))
    keys = ["kind", *VOTES, *FEATURES]
    patterns, path = write_scratch(seen.select(*[f"x.{k}" for k in keys]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "pii")
    weights = _fit(patterns)
    drop_scratch(docs.sparkSession, path)

    def accepted(x: Column) -> Column:
        logit = _by_kind([w[0] for w in weights], x["kind"])
        for j, f in enumerate(FEATURES):
            logit = logit + F.when(x[f] == 1, _by_kind([w[2 + 2 * j] for w in weights], x["kind"])).otherwise(
                _by_kind([w[1 + 2 * j] for w in weights], x["kind"])
            )
        return (x["form"] != 0) & (logit > 0)

    def written(spans: Column) -> Column:
        name = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["kind"] + 1), x["lo"].cast("string"), x["hi"].cast("string"))), ",")

    short = lambda x: F.struct(x["kind"].alias("kind"), x["lo"].alias("lo"), x["hi"].alias("hi"))
    split = rows.select(
        "doc_id",
        F.transform(F.filter("found", lambda x: x["form"] == 0), short).alias("base"),
        F.transform(F.filter("found", accepted), short).alias("more"),
    )
    of = lambda spans, k: F.filter(spans, lambda x: x["kind"] == k)

    def apart(k: int) -> Column:
        return _let(of("base", k), lambda base: F.filter(of("more", k), lambda x: ~_overlaps(base, x)))

    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return split.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(F.array_sort("base")), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", *[apart(k) for k in range(len(KINDS))]))).alias("spans"),
    )
