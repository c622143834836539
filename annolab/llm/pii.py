"""Personal data by weak supervision, DataFrame and SQL functions only.

Base spans (email, ip, card, phone) are the valid leftmost matches of fixed
patterns. Looser patterns propose further candidates: numbers written like phones
without a plus sign, card-like digit groups that fail the checksum, addresses and
mails with [at], (dot) and the like. Five labelers vote on every candidate
(1 personal, 0 not, NULL abstains):

* strict  - the base pattern and its check (digits, checksum, range);
* list    - gazetteer: known top-level domains, issuer digits, reserved networks;
* context - cue words in the 32 characters before (for and against);
* shape   - length and separators as usual for the kind;
* edge    - stands free, not inside a longer word or number.

Votes are counted over the corpus per kind and vote pattern (at most 4 x 3^5
rows); expectation-maximisation on these counts estimates each labeler's
reliability and a probability for every pattern. With these as soft labels a span
classifier (naive Bayes over the candidate's features: votes, length and digit
classes, where it stands) is trained from one more aggregate; candidates it gives
``accept`` or more become spans unless they overlap a base span. Base spans stay.

Positions are code points, the end exclusive. Spans are found in every whole text.

Defined cases: NULL text is empty; texts without candidates have no spans and the
digest of the empty text; repeated rows are handled alike; without any candidate
in the corpus nothing is added; other columns are kept.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: kinds in the order of the result, and their patterns (each starts
# where a leftmost search would; possessive, so that long runs cost linear time)
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: a text without this has no candidate of the kind
HINTS = {"email": r"@|(?i:at[\])])", "ip": r"[0-9]", "card": r"[0-9]", "phone": r"[0-9]"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?i:at)[\])] ?[A-Za-z0-9-]++"
             r"(?:(?:\.| ?[\[(](?i:dot)[\])] ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\[\.\][0-9]{1,3}+){3}",
    "card": r"(?<![0-9A-Za-z+.=-])[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# fixed values: the gazetteers and cue words
LISTED = {
    "email": r"(?i)\b(?:com|org|net|edu|gov|io|de|fr|es|it|uk|info)$",
    "ip": r"^(?:10|127|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168)\b",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65)",
    "phone": r"^(?:\+?1\b|\+(?:33|34|44|49)\b|\(?[2-9][0-9]{2}\)?)",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|reach|courriel|correo)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b",
}
AGAINST = r"(?i)\b(?:isbn|order|invoice|version|section|serial|no|nr|id|ref|page|doi)\b[.:#]?\s*$"
LABELERS = ("strict", "listed", "context", "shape", "edge")
FEATURES = ("size", "digits", "alone")
ACCEPT = 0.9
BLOCK = 512                # matches summed up at once
PLACES = 26                # bits of the number of matches of a text
SPAN = "array<struct<start:int,end:int,text:string,before:string,next:string>>"
BEFORE = 32                # characters of context


def matches(df: DataFrame, out: str, pattern: str, hint: str) -> DataFrame:
    """df plus ``out``: spans (start, end, text, the characters before, the next one) of the
    non-overlapping matches in ``__text``. The pieces between matches give the positions and the
    surroundings, as reading at a position of a long text costs the way to it; they are
    summed up in blocks, so that an array that grows by one element is never long."""
    text = F.col("__text")
    none = F.array().cast(SPAN)
    df = (df.withColumn("__found", F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
          .withColumn("__pieces", F.when(F.size("__found") > 0, F.split(text, pattern, -1))))
    pairs = F.zip_with("__pieces", "__found", lambda p, f: F.struct(p.alias("p"), f.alias("t")))
    follow = F.slice(pairs, 2, F.size("__pieces"))
    sized = F.zip_with(pairs, follow, lambda x, y: F.struct(
        x["p"].alias("p"), x["t"].alias("t"),
        F.substring(F.concat(F.substring(y["p"], 1, 1), F.coalesce(y["t"], F.lit(""))), 1, 1).alias("next")))

    def step(acc, x):
        a, n = acc["at"] + F.length(x["p"]), F.length(x["t"])
        near = F.right(F.concat(acc["near"], F.right(x["p"], F.lit(BEFORE))), F.lit(BEFORE))
        span = F.struct(a.alias("start"), (a + n).alias("end"), x["t"].alias("text"), near.alias("before"), x["next"].alias("next"))
        return F.struct((a + n).alias("at"), F.right(F.concat(near, x["t"]), F.lit(BEFORE)).alias("near"),
                        F.concat(acc["out"], F.array(span)).alias("out"))

    def block(acc, part):
        own = F.aggregate(part, F.struct(acc["at"].alias("at"), acc["near"].alias("near"), none.alias("out")), step)
        return F.transform(F.array(own), lambda o: F.struct(
            o["at"].alias("at"), o["near"].alias("near"), F.concat(acc["out"], F.array(o["out"])).alias("out")))[0]

    df = df.withColumn("__sized", F.filter(sized, lambda x: x["t"].isNotNull()))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__sized") - 1) / BLOCK).cast("int")),
                         lambda b: F.slice("__sized", b * BLOCK + 1, BLOCK))
    df = df.withColumn("__blocks", F.when(F.size("__sized") > 0, blocks))
    walked = F.aggregate("__blocks", F.struct(F.lit(0).alias("at"), F.lit("").alias("near"),
                                                  F.array().cast(f"array<{SPAN}>").alias("out")),
                         block, lambda acc: F.flatten(acc["out"]))
    return df.withColumn(out, F.coalesce(walked, none)).drop("__found", "__pieces", "__sized", "__blocks")


def digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """Checksum over the digits of t (13 to 19 of them)."""
    d = F.split(F.reverse(digits(t)), "")
    doubled = F.transform(F.filter(d, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.length(digits(t)).between(13, 19) & (F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0)


def valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        return t.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return luhn(t)
    if kind == "phone":
        return F.length(digits(t)).between(9, 15)
    return F.lit(True)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs plus __text (NULL as empty) and the array __<kind> of the base spans."""
    out = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    for kind in KINDS:
        out = matches(out, f"__{kind}", PATTERNS[kind], HINTS[kind] if kind == "email" else (
            r"\+[0-9]" if kind == "phone" else r"[0-9]"))
    for kind in KINDS:
        out = out.withColumn(f"__{kind}", checked(kind))
    return out


def checked(kind: str) -> Column:
    return F.filter(f"__{kind}", lambda s: valid(kind, s["text"]))


def overlaps(spans: str, c: Column) -> Column:
    """Does a span overlap one of an array's, which are in order and apart? The number of those
    that end before it is found bit by bit."""
    steps = F.array(*[F.lit(1 << k) for k in range(PLACES, -1, -1)])
    before = F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        F.get(F.col(spans), n + step - 1)["end"] <= c["start"], n + step).otherwise(n))
    return F.coalesce(F.get(F.col(spans), before)["start"] < c["end"], F.lit(False))


def candidates(kind: str) -> Column:
    """Loose matches that overlap no base span."""
    return F.filter(f"__{kind}_loose", lambda c: ~reduce(lambda a, b: a | b, [
        F.when(F.size(f"__{k}") > 0, overlaps(f"__{k}", c)).otherwise(F.lit(False)) for k in KINDS]))


def judged(kind: str, spans: Column, base: bool) -> Column:
    """Spans with the labelers' votes and the classifier's features."""
    def one(s):
        t, before = s["text"], s["before"]
        around = F.concat(F.right(before, F.lit(1)), F.lit("|"), s["next"])
        n = F.length(digits(t))
        shape = {"email": F.length(t).between(6, 64), "ip": F.length(t).between(7, 15), "card": n == 16,
                 "phone": n.between(10, 13)}[kind]
        bare = t if kind != "card" else digits(t)
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), t.alias("text"),
            F.lit(1 if base else 0).alias("strict"),
            F.when(bare.rlike(LISTED[kind]), 1).when(F.lit(kind in ("email", "card")), 0).alias("listed"),
            F.when(before.rlike(CUES[kind]), 1).when(before.rlike(AGAINST), 0).alias("context"),
            shape.cast("int").alias("shape"), (~around.rlike("[A-Za-z0-9]")).cast("int").alias("edge"),
            F.least(F.floor(F.length(t) / 8), F.lit(5)).cast("int").alias("size"),
            F.least(F.floor(n / 4), F.lit(5)).cast("int").alias("digits"),
            (F.trim(around) == "|").cast("int").alias("alone"))

    return F.transform(spans, one)


def all_judged(base: DataFrame) -> DataFrame:
    """base plus, per kind, __<kind>_all: base spans and candidates with votes."""
    out = base
    for kind in KINDS:
        out = matches(out, f"__{kind}_loose", LOOSE[kind], HINTS[kind])
    for kind in KINDS:
        out = out.withColumn(f"__{kind}_loose", candidates(kind))
    for kind in KINDS:
        out = out.withColumn(f"__{kind}_all", F.concat(judged(kind, F.col(f"__{kind}"), True),
                                                       judged(kind, F.col(f"__{kind}_loose"), False)))
    return out


def expectation_maximisation(counts: dict, rounds: int = 50) -> tuple[dict, dict]:
    """counts: {votes: n}. Returns {votes: probability} and {labeler: (P(1|1), P(1|0))}."""
    prior, rates = 0.5, {k: [0.8, 0.2] for k in range(len(LABELERS))}
    prob: dict = {}
    for _ in range(rounds):
        for votes in counts:
            a, b = math.log(prior), math.log(1 - prior)
            for k, v in enumerate(votes):
                if v is not None:
                    a += math.log(rates[k][0] if v else 1 - rates[k][0])
                    b += math.log(rates[k][1] if v else 1 - rates[k][1])
            prob[votes] = 1 / (1 + math.exp(min(500, b - a)))
        total = sum(counts.values())
        prior = min(0.999, max(0.001, sum(n * prob[v] for v, n in counts.items()) / total))
        for k in range(len(LABELERS)):
            for side in (0, 1):
                weight = [(n * (prob[v] if side == 0 else 1 - prob[v]), v[k]) for v, n in counts.items() if v[k] is not None]
                # two pseudo-votes that the labeler is right hold the sides apart
                yes = sum(w for w, v in weight if v) + (1.6 if side == 0 else 0.4)
                rates[k][side] = min(0.999, max(0.001, yes / (sum(w for w, _ in weight) + 2)))
    return prob, {LABELERS[k]: tuple(r) for k, r in rates.items()}


def learn(judged_docs: DataFrame) -> dict:
    """Per kind the classifier's log odds: {kind: (bias, {(feature, value): weight})}."""
    rows = judged_docs.select(F.explode(F.concat(*[F.col(f"__{kind}_all") for kind in KINDS])).alias("s")).select(
        "s.kind", *[F.col(f"s.{c}").alias(c) for c in (*LABELERS, *FEATURES)])
    # bounded by the numbers of vote patterns and feature values
    counted = rows.groupBy("kind", *LABELERS, *FEATURES).agg(F.count("*").alias("n")).collect()
    model = {}
    for kind in KINDS:
        own = [r for r in counted if r["kind"] == kind]
        votes: dict = defaultdict(int)
        for r in own:
            votes[tuple(r[c] for c in LABELERS)] += r["n"]
        if not votes:
            continue
        prob, _ = expectation_maximisation(votes)
        yes, no, y, n = defaultdict(float), defaultdict(float), 1.0, 1.0
        for r in own:
            p = prob[tuple(r[c] for c in LABELERS)]
            y, n = y + p * r["n"], n + (1 - p) * r["n"]
            for c in (*LABELERS, *FEATURES):
                yes[c, r[c]] += p * r["n"]
                no[c, r[c]] += (1 - p) * r["n"]
        weights = {k: math.log((yes[k] + 1) / (y + 2)) - math.log((no[k] + 1) / (n + 2)) for k in yes}
        model[kind] = (math.log(y / n), weights)
    return model


def probability(s: Column, bias: float, weights: dict) -> Column:
    total = F.lit(bias)
    for c in (*LABELERS, *FEATURES):
        part = F.lit(0.0)
        for (name, value), w in sorted(weights.items(), key=str):
            if name == c:
                same = s[c].isNull() if value is None else s[c] == value
                part = F.when(F.coalesce(same, F.lit(False)), w).otherwise(part)
        total = total + part
    return 1 / (1 + F.exp(-total))


def find(docs: DataFrame, accept: float = ACCEPT, text: str = "text") -> DataFrame:
    """docs plus base and spans: arrays of (kind, start, end) by kind as listed, then
    start."""
    keep = [c for c in docs.columns if c not in ("base", "spans")]
    all_docs = all_judged(with_base(docs.select(*keep), text))
    model = learn(all_docs)
    base, spans = [], []
    for kind in KINDS:
        base.append(plain(kind, F.col(f"__{kind}")))
        spans.append(F.array_sort(plain(kind, accepted(kind, model.get(kind), accept))))
    return all_docs.select(*keep, F.concat(*base).alias("base"), F.concat(*spans).alias("spans"))


def plain(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                                 s["end"].alias("end")))


def accepted(kind: str, model: tuple | None, accept: float) -> Column:
    """The base spans and the candidates that the classifier takes."""
    if model is None:
        return F.col(f"__{kind}")
    return F.filter(f"__{kind}_all", lambda s: (s["strict"] == 1) | (probability(s, *model) >= accept))


def number(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """docs with every span (overlapping ones together) replaced by its kind, e.g. [EMAIL];
    NULL texts stay NULL."""
    found = find(docs, accept)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        return F.when(s["start"] >= acc["at"], F.struct(
            s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                   s["kind"].alias("kind"))))
    clean = F.aggregate(ordered, start, step, lambda acc: F.concat(
        acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    return found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))).drop("base", "spans")
