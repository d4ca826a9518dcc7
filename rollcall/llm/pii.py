r"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates of six kinds are found in whole texts: the base kinds (email, ip, card, phone)
by their fixed patterns, secrets and social security numbers by patterns of this module.
Matches of a base kind that pass its check are base spans and always stay.  On every other
candidate five labelers vote yes, no or nothing: the shape of the match, its checksum or
range, a gazetteer (top-level domains, card issuers, calling codes), the words before it
and the characters around it.  Votes are counted per kind and pattern of votes; on these
counts, whose number is bounded by kinds and votes, expectation-maximisation estimates how
reliable each labeler is, and a logistic classifier is trained on the resulting
probabilities.  Candidates it accepts become spans unless they overlap a base span.

Patterns are written so that a match never has to be tried twice from one run of
characters; they find what the plain forms beside them find.  Positions come from the
lengths of what lies between the matches, so one pass per kind gives them all.

DataFrame functions only; no row is shuffled but the counts of votes.  Defined results: a
null text is an empty one without spans; equal rows give equal rows; an empty table gives
an empty result; with no candidate at all nothing is learned and nothing added; spans are
in code points, end exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import pin

KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
BASE_KINDS = KINDS[:4]

_LOCAL = "[A-Za-z0-9._%+-]"
# \G lets a match begin right behind the one before; possessive quantifiers keep the matcher
# from recursing on long runs.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Text without this has no match, so that the pattern need not run.
NEEDS = {"email": "@", "phone": "+", "ssn": "-"}

# Gazetteers and words of context.
DOMAINS = ("com", "org", "net", "edu", "gov", "int", "io", "info", "biz", "de", "fr", "es", "it", "nl", "uk", "eu", "us", "ca", "au", "jp", "cn", "in", "br")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "90", "91")
CONTEXT = {
    "email": "mail|contact|write|address",
    "ip": r"\bip\b|host|server|addr|login",
    "card": "card|visa|credit|payment|account",
    "phone": r"phone|\btel\b|call|mobile|fax",
    "secret": "token|secret|passw|api|key|auth",
    "ssn": "ssn|social|security",
}
AGAINST = r"version|release|isbn|order|invoice|commit|checksum|md5|sha"
#: Characters before a match that count as its context.
BEFORE = 40

LABELERS = ("shape", "check", "gazetteer", "context", "alone")
ROUNDS = 60
STEPS = 400
ACCEPT = 0.5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    figures = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    doubled = F.transform(figures, lambda x, i: F.when(i % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(s: Column) -> Column:
    """Every part at most 255, however many zeros lead it."""
    return F.forall(F.split(s, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda q: (F.length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255)))


def _fits(kind: str, s: Column) -> Column:
    """What a match has to pass to be a base span."""
    if kind == "ip":
        return _octets(s)
    if kind == "card":
        return let(_digits(s), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(kind == "email")


def _candidate(kind: str, s: Column) -> Column:
    """Matches that are worth a vote: a short number is no card, nor a long one a phone."""
    if kind == "card":
        return F.length(_digits(s)).between(13, 19)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "y").when(no, "n").otherwise("-")


def _starts(code: str, options: tuple[str, ...]) -> str:
    return f"^{code}(?:{'|'.join(options)})"


def votes(kind: str, s: Column, before: Column, after: Column) -> Column:
    """One letter per labeler: y, n or - for nothing."""
    never = F.lit(False)
    near = F.lower(F.right(before, F.lit(BEFORE)))
    shape = {
        "email": _vote(s.rlike(r"\.[A-Za-z]{2,}$"), s.rlike(r"\.[0-9-]+$")),
        "ip": _vote(s.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"), s.rlike("[0-9]{4}")),
        "card": _vote(s.rlike("^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})$"), s.rlike("[ -][0-9]{1,2}[ -]")),
        "phone": _vote(s.rlike(r"[ ().-]"), never),
        "secret": _vote(s.rlike("[A-Za-z]") & s.rlike("[0-9]"), ~s.rlike("[A-Za-z]")),
        "ssn": _vote(s.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), s.rlike("^(?:000|666|9)|-00-|-0000$")),
    }[kind]
    check = {
        "ip": let(_octets(s), lambda fits: _vote(fits, ~fits)),
        "card": let(_fits("card", s), lambda fits: _vote(fits, ~fits)),
    }.get(kind, F.lit("-"))
    gazetteer = {
        "email": let(F.lower(F.substring_index(s, ".", -1)).isin(*DOMAINS), lambda known: _vote(known, ~known)),
        "ip": _vote(never, s.rlike(r"^0*(?:0|127|255)\.")),
        "card": let(_digits(s).rlike(_starts("", ("4", "5[1-5]", "2[2-7]", "3[47]", "6011", "65"))), lambda known: _vote(known, never)),
        "phone": let(s.rlike(_starts(r"\+", CALLING_CODES)), lambda known: _vote(known, ~known)),
        "secret": _vote(s.rlike("^(?:AKIA|gh|sk-)"), never),
    }.get(kind, F.lit("-"))
    context = _vote(near.rlike(CONTEXT[kind]), near.rlike(AGAINST))
    joined = F.right(before, F.lit(1)).rlike(r"[\p{L}0-9_/.]") | F.left(after, F.lit(1)).rlike(r"[\p{L}0-9_/]")
    return F.concat(shape, check, gazetteer, context, _vote(~joined, joined))


def _found(kind: str, text: Column) -> Column:
    """Candidates of a kind in order: kind, start, end, base, votes."""
    number = KINDS.index(kind)
    pattern = PATTERNS[kind]

    def positions(s: Column) -> Column:
        sizes = F.transform(s["hits"], lambda h, i: F.struct(F.length(F.get(s["parts"], i)).alias("gap"), F.length(h).alias("size")))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        step = lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["size"]).alias("at"), F.concat(a["starts"], F.array(a["at"] + x["gap"])).alias("starts")
        )
        return F.aggregate(sizes, first, step, lambda a: a["starts"])

    def rows(s: Column, starts: Column) -> Column:
        return F.transform(s["hits"], lambda h, i: F.struct(
            F.lit(number).alias("kind"),
            F.get(starts, i).alias("start"),
            (F.get(starts, i) + F.length(h)).alias("end"),
            _fits(kind, h).alias("base"),
            F.when(_candidate(kind, h), votes(kind, h, F.get(s["parts"], i), F.get(s["parts"], i + 1))).alias("votes"),
        ))

    none = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,votes:string>>")
    split = lambda hits: F.struct(hits.alias("hits"), F.split(text, pattern, -1).alias("parts"))
    every = lambda hits: let(split(hits), lambda s: let(positions(s), lambda at: rows(s, at)))
    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) > 0, every(hits)).otherwise(none))
    some = F.filter(some, lambda c: c["base"] | c["votes"].isNotNull())
    return F.when(text.contains(NEEDS[kind]), some).otherwise(none) if kind in NEEDS else some


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and all candidates of each text, by kind and start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(*[_found(kind, text) for kind in KINDS]).alias("found"))


def counts(found: DataFrame) -> list[tuple[int, str, int]]:
    """(kind, votes, number of candidates); at most kinds times patterns of votes."""
    rows = found.select(F.explode("found").alias("c")).filter("c.votes is not null")
    return sorted(tuple(r) for r in rows.groupBy("c.kind", "c.votes").count().collect())


def reliabilities(table: list[tuple[int, str, int]], rounds: int = ROUNDS) -> tuple[dict, dict, dict]:
    """EM: share of true candidates per kind, P(vote | truth) per labeler, P(true) per pattern."""
    prior = dict.fromkeys(range(len(KINDS)), 0.5)
    # yes is likelier for true candidates: this settles which class is which
    told = {(k, z, v): p for k in range(len(LABELERS)) for z, ps in ((1, (0.6, 0.1, 0.3)), (0, (0.1, 0.6, 0.3))) for v, p in zip("yn-", ps, strict=True)}
    true: dict[tuple[int, str], float] = {}
    for _ in range(rounds):
        for kind, pattern, _n in table:
            log = [math.log(1 - prior[kind]), math.log(prior[kind])]
            for k, v in enumerate(pattern):
                log = [log[z] + math.log(told[k, z, v]) for z in (0, 1)]
            true[kind, pattern] = 1 / (1 + math.exp(max(-500.0, min(500.0, log[0] - log[1]))))
        for kind in prior:
            mine = [(n, true[x, p]) for x, p, n in table if x == kind]
            prior[kind] = (sum(n * p for n, p in mine) + 1) / (sum(n for n, _ in mine) + 2)
        for k in range(len(LABELERS)):
            for z in (0, 1):
                mass = {v: sum(n * (true[x, p] if z else 1 - true[x, p]) for x, p, n in table if p[k] == v) + 1 for v in "yn-"}
                for v in "yn-":
                    told[k, z, v] = mass[v] / sum(mass.values())
    return prior, told, true


def _features(kind: int, pattern: str) -> list[float]:
    return [float(kind == k) for k in range(len(KINDS))] + [{"y": 1.0, "n": -1.0, "-": 0.0}[v] for v in pattern]


def train(table: list[tuple[int, str, int]], steps: int = STEPS) -> list[float]:
    """Weights of the logistic classifier, fitted to the probabilities that EM gives."""
    weights = [0.0] * (len(KINDS) + len(LABELERS))
    if not table:
        return weights
    _, _, true = reliabilities(table)
    rows = [(_features(k, p), n, true[k, p]) for k, p, n in table]
    total = sum(n for _, n, _ in rows)
    for _ in range(steps):
        slope = [0.001 * w for w in weights]
        for x, n, p in rows:
            miss = 1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x, strict=True)))) - p
            slope = [s + n / total * miss * v for s, v in zip(slope, x, strict=True)]
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def accepted(candidate: Column, weights: list[float], at_least: float = ACCEPT) -> Column:
    """Whether the classifier takes a candidate for personal data."""
    score = F.get(F.array(*[F.lit(w) for w in weights[: len(KINDS)]]), candidate["kind"])
    for k, w in enumerate(weights[len(KINDS) :]):
        vote = F.substring(candidate["votes"], k + 1, 1)
        score = score + F.when(vote == "y", w).when(vote == "n", -w).otherwise(0.0)
    return F.coalesce(score > math.log(at_least / (1 - at_least)), F.lit(False))


def _listed(spans: Column) -> Column:
    kind = lambda c: F.get(F.array(*map(F.lit, KINDS)), c["kind"])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", kind(c), c["start"].cast("string"), c["end"].cast("string"))), ",")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of kind, start, end, base and votes."""
    found = pin(candidates(docs), "pii")
    weights = train(counts(found))
    base = found.withColumn("base", F.filter("found", lambda c: c["base"]))
    clear = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    chosen = F.filter("found", lambda c: c["base"] | F.when(accepted(c, weights), clear(c)).otherwise(False))
    return base.select("doc_id", "base", chosen.alias("spans"))


def summary(found: DataFrame) -> DataFrame:
    """The digest of ``spans``: base counts, checksum of the base spans, all spans as text."""
    number = lambda k: F.size(F.filter("base", lambda c: c["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
