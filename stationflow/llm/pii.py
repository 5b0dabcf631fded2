"""Personal data by weak supervision, in DataFrame functions alone.

Regular expressions propose spans. Labelers (checksums, gazetteers, words before the span, its surroundings and its
shape) vote on each: 1 for, -1 against, 0 for none. Expectation-maximisation estimates how reliable each labeler is from
the counts of vote patterns, without any truth given. The resulting probabilities train the final classifier, a naive
Bayes model of the span's kind, shape and surroundings, which decides on spans beyond the base ones.

The corpus is read once. What is gathered from it are counts: of vote patterns (3 to the number of labelers for each
kind at most) and of classifier features (bounded buckets), however many spans there are.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import stored

#: Base patterns of the contract in an equivalent form that never backtracks over a run twice.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What the method may add.
MORE = {
    "local_phone": r"(?<![0-9+()-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?i)\b(?:password|passwd|token|secret|api_?key)\x20{0,3}[=:]\x20{0,3}\"?[A-Za-z0-9_/+-]{8,}+\"?",
    "spaced_email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[a-z0-9-]++\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[a-z]{2,12}\b",
}
KINDS = [*BASE, *MORE]

#: Gazetteers and cue words.
DOMAINS = "com org net edu gov io de fr es uk eu info example ch nl se pl cz jp cn br mx ru au nz ca dev app biz".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91 92".split()
CARD_STARTS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
CUES = {
    "email": "mail|email|e-mail|contact|write|correo|courriel|schreib",
    "ip": "ip|host|server|address|adresse|login|from",
    "card": "card|visa|credit|pay|tarjeta|carte|karte|konto",
    "phone": "call|phone|tel|mobile|fax|ring|llame|appel|ruf",
    "local_phone": "call|phone|tel|mobile|fax|ring|llame|appel|ruf",
    "secret": "login|auth|config|export|set|key|secret|credential",
    "spaced_email": "mail|email|e-mail|contact|write|correo|courriel|schreib",
}
AGAINST = "version|release|isbn|issn|doi|section|chapter|page|rfc"
#: Probability from which a span is added, EM rounds, and added weight of the labelers' starting accuracy.
THRESHOLD, ROUNDS, PSEUDO = 0.5, 12, 10.0
LABELERS = ["shape", "checksum", "gazetteer", "context", "edges", "case"]

_SPAN = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def passes_luhn(x: Column) -> Column:
    """Whether a text of digits has a right check digit."""
    places = F.transform(F.filter(F.split(F.reverse(x), ""), lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(places, F.lit(0), lambda s, d: s + d) % 10 == 0


def octets_fit(x: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return x.rlike(rf"^{part}(?:\.{part}){{3}}$")


def holds(kind: str, hit: Column) -> Column:
    """The contract's test of a base match."""
    if kind == "ip":
        return octets_fit(hit)
    if kind == "card":
        return F.length(digits(hit)).between(13, 19) & passes_luhn(digits(hit))
    if kind == "phone":
        return F.length(digits(hit)).between(9, 15)
    return F.lit(True)


def located(hits: Column, gaps: Column) -> Column:
    """Matches with their places (code points) and surroundings, from the matches and the text between them."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc: Column, i: Column) -> Column:
        gap, hit = F.get(gaps, i), F.get(hits, i)
        begin = acc["at"] + F.length(gap)
        end = begin + F.length(hit)
        span = F.struct(begin.alias("start"), end.alias("end"), hit.alias("hit"), F.lower(F.right(gap, F.lit(24))).alias("before"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    found = F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda acc: acc["out"])
    return F.when(F.size(hits) > 0, found).otherwise(F.array().cast(_SPAN))


def one_of(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def votes(kind: str, s: Column) -> list[Column]:
    """Votes of LABELERS on a span of this kind."""
    hit, before, after = s["hit"], s["before"], s["after"]
    n, number = F.length(hit), digits(hit)
    letters, figures = hit.rlike("[A-Za-z]"), hit.rlike("[0-9]")
    if kind in ("email", "spaced_email"):
        shape = _vote(n.between(6, 64), n > 120)
        listed = F.array_contains(one_of(DOMAINS), F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1)))
        # Spelled out, an address is told from a sentence by its last part alone, which must be a domain's.
        checksum = _vote(hit.rlike(r"[A-Za-z]{2,12}$"), hit.rlike(r"[0-9-]$")) if kind == "email" else _vote(listed, ~listed)
        gazetteer = _vote(listed, F.lit(False))
    elif kind == "ip":
        shape = _vote(n.between(7, 15), n > 15)
        checksum = _vote(octets_fit(hit), ~octets_fit(hit))
        gazetteer = _vote(hit.rlike(r"^(?:10|127|192\.168|172\.16)\."), hit.rlike(r"^0"))
    elif kind == "card":
        shape = _vote(F.length(number).between(13, 19), ~F.length(number).between(13, 19))
        checksum = _vote(passes_luhn(number), ~passes_luhn(number))
        gazetteer = _vote(number.rlike(CARD_STARTS), number.rlike(r"^[0189]"))
    elif kind in ("phone", "local_phone"):
        size = F.length(number)
        shape = _vote(size.between(9, 15), ~size.between(9, 15))
        checksum = _vote(hit.rlike(r"[0-9][\x20().-]+[0-9]"), number.rlike(r"^([0-9])\1+$"))
        codes = F.array_contains(one_of(CALLING_CODES), F.left(number, F.lit(1))) | F.array_contains(one_of(CALLING_CODES), F.left(number, F.lit(2)))
        gazetteer = _vote(codes, F.lit(False)) if kind == "phone" else _vote(number.rlike(r"^[2-9]"), number.rlike(r"^[01]"))
    else:
        shape = _vote(n >= 20, n < 12)
        checksum = _vote(letters & figures, ~figures)
        gazetteer = _vote(hit.rlike(r"(?i)^(?:password|token|secret|api)"), F.lit(False))
    context = _vote(before.rlike(rf"(?:{CUES[kind]})[^a-z]*$"), before.rlike(rf"(?:{AGAINST})[^a-z]*$"))
    edges = _vote((before.rlike(r"[\s(\[<\"':,;]$") | (before == "")) & (after.rlike(r"^[\s.,;:!?)\]>\"']") | (after == "")), before.rlike(r"[0-9A-Za-z]$") | after.rlike(r"^[0-9A-Za-z]"))
    case = _vote(hit.rlike(r"^[^A-Z]*$"), hit.rlike(r"^[^a-z]*[A-Z][^a-z]*$"))
    return [shape, checksum, gazetteer, context, edges, case]


def features(kind: Column, s: Column) -> list[Column]:
    """Bounded buckets that the final classifier reads, each with its place in the list."""
    hit = s["hit"]
    size = F.least(F.length(hit), F.lit(63)).cast("int")
    count = F.least(F.length(digits(hit)), F.lit(31)).cast("int")
    marks = F.least(F.length(F.regexp_replace(hit, r"[A-Za-z0-9]", "")), F.lit(15)).cast("int")
    word = F.regexp_extract(s["before"], r"([\p{L}]{1,24})[^\p{L}]*$", 1)
    values = [
        F.floor(size / 4).cast("string"), count.cast("string"), marks.cast("string"), F.pmod(F.hash(word), F.lit(256)).cast("string"),
        F.when(s["before"] == "", "edge").when(s["before"].rlike(r"\s$"), "space").otherwise("other"), F.when(s["after"] == "", "edge").when(s["after"].rlike(r"^\s"), "space").otherwise("other"),
    ]
    return [F.concat_ws("|", kind, F.lit(str(i)), v) for i, v in enumerate(values)]


def proposals(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id and the matches of each kind with their places; no text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("string").alias("text"))
    patterns = BASE | MORE
    rows = rows.select("doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"{k}_hits") for k, p in patterns.items()])
    gap = lambda k, p: F.when(F.size(f"{k}_hits") > 0, F.split("text", p, -1)).alias(f"{k}_gaps")
    rows = rows.select("doc_id", *[f"{k}_hits" for k in patterns], *[gap(k, p) for k, p in patterns.items()])
    return rows.select("doc_id", *[located(F.col(f"{k}_hits"), F.col(f"{k}_gaps")).alias(k) for k in patterns])


def judged(found: DataFrame) -> DataFrame:
    """Proposals as spans: doc_id, base (that hold the contract's test) and open (all others, with votes and features)."""

    def base(kind: str) -> Column:
        return F.transform(F.filter(kind, lambda s: holds(kind, s["hit"])), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def opened(kind: str) -> Column:
        return F.transform(
            kind,
            lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.array(*votes(kind, s)).alias("votes"), F.array(*features(F.lit(kind), s)).alias("features"),
                (holds(kind, s["hit"]) if kind in BASE else F.lit(False)).alias("is_base"),
            ),
        )

    return found.select("doc_id", *[F.size(base(k)).cast("long").alias(f"n_{k}") for k in BASE], F.concat(*[base(k) for k in BASE]).alias("base"), F.concat(*[opened(k) for k in KINDS]).alias("open"))


def probability(weights: list[float], priors: dict[str, float]) -> Column:
    """Of a true span, given its votes: log-odds of each labeler's accuracy, for or against, and the kind's prior."""
    prior = F.element_at(F.create_map(*[F.lit(x) for k in KINDS for x in (k, priors[k])]), F.col("kind"))
    odds = reduce(lambda a, b: a + b, [F.get(F.col("votes"), F.lit(j)) * F.lit(w) for j, w in enumerate(weights)], prior)
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> tuple[list[float], dict[str, float]]:
    """EM over counted vote patterns (kind, votes, n): weights of the labelers and log-odds of the kinds.

    Each round is one aggregate over the patterns; only its sums reach the driver.
    """
    accuracy, share = [0.8] * len(LABELERS), dict.fromkeys(KINDS, 0.5)
    odds = lambda p: math.log(p / (1 - p))
    for _ in range(rounds):
        p = probability([odds(a) for a in accuracy], {k: odds(s) for k, s in share.items()})
        rows = patterns.withColumn("p", p)
        vote = lambda j: F.get(F.col("votes"), F.lit(j))
        right = [F.sum(F.col("n") * F.when(vote(j) > 0, F.col("p")).when(vote(j) < 0, 1 - F.col("p")).otherwise(0.0)).alias(f"right_{j}") for j in range(len(LABELERS))]
        cast = [F.sum(F.col("n") * F.abs(vote(j))).alias(f"cast_{j}") for j in range(len(LABELERS))]
        kinds = [F.sum(F.when(F.col("kind") == k, F.col("n") * F.col("p"))).alias(f"true_{k}") for k in KINDS] + [F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"all_{k}") for k in KINDS]
        sums = rows.agg(*right, *cast, *kinds).first()
        accuracy = [min(0.99, max(0.5, (0.8 * PSEUDO + (sums[f"right_{j}"] or 0)) / (PSEUDO + (sums[f"cast_{j}"] or 0)))) for j in range(len(LABELERS))]
        share = {k: min(0.99, max(0.01, (1 + (sums[f"true_{k}"] or 0)) / (2 + (sums[f"all_{k}"] or 0)))) for k in KINDS}
    return [odds(a) for a in accuracy], {k: odds(s) for k, s in share.items()}


def find_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, counts and spans (kind, start, end) of the base, and all spans with the added ones.

    Null and empty texts have no spans; repeated rows and rows without doc_id are judged like all others.
    """
    found = stored(judged(proposals(docs)), "spans")
    spans = found.select(F.explode("open").alias("s")).select("s.kind", "s.votes", "s.features")
    counted = spans.groupBy("kind", "votes").agg(F.count("*").alias("n"))
    weights, priors = estimate(stored(counted, "patterns"))
    # Naive Bayes: of each feature, the weight of true and false spans; the table's size is that of the buckets.
    belief = spans.withColumn("p", probability(weights, priors)).select("kind", "p", F.explode("features").alias("feature"))
    table = belief.groupBy("feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    total = spans.withColumn("p", probability(weights, priors)).groupBy("kind").agg(F.sum("p").alias("all_yes"), F.sum(1 - F.col("p")).alias("all_no"))
    total = F.broadcast(total)  # one row for each kind
    scored = table.withColumn("kind", F.substring_index("feature", "|", 1)).join(total, "kind")
    weight = F.log((F.col("yes") + 0.5) / (F.col("all_yes") + 16)) - F.log((F.col("no") + 0.5) / (F.col("all_no") + 16))
    prior = F.log((F.col("all_yes") + 0.5) / (F.col("all_no") + 0.5))
    pairs = scored.select("feature", weight.alias("w")).unionByName(total.select(F.col("kind").alias("feature"), prior.alias("w")))
    # A row for each kind and bucket, whose number is fixed: small enough for a constant of the last pass.
    model = {r["feature"]: r["w"] for r in pairs.collect()}
    weights_of = F.map_from_arrays(F.array(*map(F.lit, model)), F.array(*map(F.lit, model.values()))) if model else F.create_map().cast("map<string,double>")

    def belongs(s: Column) -> Column:
        odds = F.aggregate(s["features"], F.coalesce(F.element_at(weights_of, s["kind"]), F.lit(0.0)), lambda a, f: a + F.coalesce(F.element_at(weights_of, f), F.lit(0.0)))
        # A failed checksum is final, and what lies in a base span is known already. A span around a base one tells more: digits of
        # a long token may pass for a card's.
        around = lambda b: (s["start"] <= b["start"]) & (b["end"] <= s["end"])
        inside = F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]) & ~around(b))
        return ~s["is_base"] & (F.get(s["votes"], F.lit(1)) >= 0) & ~inside & (1 / (1 + F.exp(-odds)) >= threshold)

    added = F.transform(F.filter("open", belongs), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", *[f"n_{k}" for k in BASE], "base", F.concat("base", added).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end by kind (in the order of KINDS), then start, comma-joined."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(F.element_at(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Digest of find_spans(), with the number of all spans."""
    found = find_spans(docs, threshold)
    return found.select("doc_id", *[f"n_{k}" for k in BASE], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
