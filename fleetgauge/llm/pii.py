"""Personal data: fixed patterns first, then bootstrapped contexts that discover further identifiers.

Seeds are the matches of the fixed patterns; further instances are the tokens with four digits or an @
that no seed covers. The one and the two words before an instance are its lexical patterns. Pattern and instance scores are computed in
turn over the graph of both, ROUNDS times: a pattern's score is the lower end of the Wilson interval
of the share of identifiers among its distinct instances; an instance becomes an
identifier when one of its patterns scores TRUSTED. Tokens so found are added as kind `context`.

All of it is DataFrame code. The graph holds the tokens with digits, never whole texts; patterns are
summed before they shuffle. Possessive quantifiers and anchors keep the patterns linear in the length
of a text and give the same leftmost matches.

Null or empty text: no spans. Rows keep their doc_id, repeated or null; every row has its own spans.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import cut
from fleetgauge.llm.spans import counted, joined, matches, merged, overlaps, slim

#: Kinds in the order of the result, and their patterns (fixed values of the contract).
KINDS = ["email", "ip", "card", "phone", "context"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit or an @, from its first character.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Characters before a span that its context is taken from.
NEAR = 100
#: Rounds of scoring, score at which a pattern is trusted, z of its interval.
ROUNDS, TRUSTED, Z = 3, 0.9, 1.96


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.length(bare) <= 3) & (F.substring(bare, 1, 3).cast("int") <= 255)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small)
    if kind == "card":
        return F.length(_digits(value)).between(14, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _words(left: Column) -> Column:
    """The word before, then the one before that, lower-cased, from the last NEAR characters."""
    near = F.split(F.lower(F.substring(left, -NEAR, NEAR)), r"[\x20\x09-\x0D]+")
    return F.slice(F.reverse(F.filter(near, lambda w: w != "")), 1, 2)


def _placed(s: Column) -> Column:
    kept = [s[c].alias(c) for c in ("start", "order", "end", "value")]
    return F.struct(*kept, _words(s["left"]).alias("words"))


def _kept(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def base_spans(text: Column) -> Column:
    """Valid matches of the fixed patterns, of all kinds."""
    looks = {"email": (EMAIL, F.contains(text, F.lit("@"))), "ip": (IP, text.rlike(r"[0-9]\.[0-9]")),
             "card": (CARD, text.rlike("[0-9]")), "phone": (PHONE, F.contains(text, F.lit("+")))}
    parts = []
    for order, kind in enumerate(KINDS[:-1]):
        pattern, when = looks[kind]
        found = matches(text, pattern, when, order)
        parts.append(F.transform(found if kind == "email" else _kept(found, kind), _placed))
    return merged(parts)


def _instances(text: Column) -> Column:
    """Tokens that may be identifiers, without outer punctuation, with the two words before each."""
    tokens = matches(text, TOKEN, text.rlike("[0-9@]"), len(KINDS) - 1)

    def trimmed(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["value"], r"^[^\p{L}\p{N}+]*", 0))
        core = F.regexp_replace(s["value"], r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")
        start = s["start"] + lead
        return F.struct(start.alias("start"), s["order"].alias("order"), (start + F.length(core)).alias("end"), core.alias("value"),
                        _words(s["left"]).alias("words"))

    many = lambda s: (F.length(_digits(s["value"])) >= 4) | F.contains(s["value"], F.lit("@"))
    return F.filter(F.transform(tokens, trimmed), many)


def _wilson(good: Column, n: Column) -> Column:
    p = good / n
    root = F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))
    return (p + Z * Z / (2 * n) - Z * root) / (1 + Z * Z / n)


def scan_pii(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_context), a row for each row."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    docs = docs.select("doc_id", base_spans(F.col("text")).alias("base"), _instances(F.col("text")).alias("tokens"))
    docs = cut(docs.withColumn("row", F.monotonically_increasing_id()))

    # seeds with their contexts, and the tokens that no seed covers
    seeds = docs.select("row", F.explode("base").alias("t")).withColumn("seed", F.lit(1.0))
    tokens = docs.filter("size(tokens) > 0").select("row", "base", F.explode("tokens").alias("t"))
    tokens = tokens.filter(~overlaps(F.col("t"), F.col("base"))).select("row", "t", F.lit(0.0).alias("seed"))
    near, two = F.get(F.col("t.words"), F.lit(0)), F.concat_ws(" ", F.get(F.col("t.words"), F.lit(1)), F.get(F.col("t.words"), F.lit(0)))
    patterns = F.array_compact(F.array(near, F.when(F.size("t.words") > 1, two)))
    graph = seeds.unionByName(tokens).select(F.col("t.value").alias("value"), "seed", F.explode(patterns).alias("pattern"))
    graph = cut(graph.groupBy("pattern", "value").agg(F.max("seed").alias("score")))
    score = graph
    for _ in range(ROUNDS):
        patterns = score.groupBy("pattern").agg(_wilson(F.sum("score"), F.count("*")).alias("p")).filter(F.col("p") >= TRUSTED)
        found = graph.join(patterns, "pattern").groupBy("value").agg(F.max("p").alias("p"))
        score = cut(graph.join(found, "value", "left").select("pattern", "value", F.greatest("score", F.coalesce("p", F.lit(0.0))).alias("score")))
    patterns = score.groupBy("pattern").agg(_wilson(F.sum("score"), F.count("*")).alias("p")).filter(F.col("p") >= TRUSTED)
    values = graph.join(patterns.select("pattern"), "pattern").select("value").distinct()

    more = tokens.select("row", F.col("t.value").alias("value"), "t").join(values, "value")
    more = more.groupBy("row").agg(F.collect_list(F.struct("t.start", "t.order", "t.end", "value")).alias("more"))
    none = F.array().cast("array<struct<start:int,order:int,end:int,value:string>>")
    out = docs.drop("tokens").join(more, "row", "left").withColumn("more", F.coalesce("more", none))
    counts = [counted(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:-1])]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                      joined(F.concat(slim(F.col("base")), "more"), KINDS).alias("spans"), F.size("more").cast("long").alias("n_context"))
