"""Secrets: fixed patterns, and strings whose sliding-window Shannon entropy is too high for words.

Candidates are runs of 20 or more characters that keys are written in, outside of the fixed patterns'
matches. Each belongs to a character class, with a window and a threshold of its own. The window
slides over the candidate a character at a time, with the counts of all characters of the candidate at
hand: the character that leaves and the one that enters change two of them, and the sum of
n * log2(n) by what these two add or take; the entropy is log2(window) - sum / window. A candidate is a
secret when one window reaches the threshold, unless an allow-list pattern explains it. Fillers
(example, xxxx and the like) explain what is within a key's length of them, not the rest of a longer run.

All of it is DataFrame code over the rows of one scan: no shuffle. Possessive quantifiers keep
patterns linear and give the same leftmost matches. Null or empty text: no spans. Rows keep their
doc_id, repeated or null. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.spans import counted, joined, let, matches, merged, overlaps, slim

#: Kinds in the order of the result, and their patterns (fixed values of the contract).
KINDS = ["assign", "access", "hex", "entropy"]
WORDS = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = WORDS + r"""["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
#: Runs that may be keys.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Character classes, the first that fits: name, pattern, window, least entropy of a window in bits.
CLASSES = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])[0-9a-fA-F]++$", 20, 3.0),
    ("alphanumeric", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]++$", 20, 3.6),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).++$", 20, 3.7),
    ("one case and signs", r"^(?=.*[0-9])(?=.*[A-Za-z])(?=.*[-_/+=]).++$", 20, 3.85),
    ("letters", r"^(?=[^a-z]*+[a-z][^A-Z]*+[A-Z])(?=[^A-Z]*+[A-Z][^a-z]*+[a-z])[A-Za-z]++$", 20, 4.05),
]
#: What explains a candidate: UUIDs, words joined by signs with a short number at the end, one character repeated.
ALLOWED = [
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[-_/+=]*+(?:[A-Za-z]++[-_/+=]++)*+[A-Za-z]*+[0-9]{0,4}+$",
    r"^(.)\1*+$",
]
#: Fillers, and how far they explain what is around them: the usual length of a key.
FILLERS = r"(?i:example|placeholder|changeme|dummy|xxxx|abcdefgh|0123456789|1234567890)"
REACH = 64


def base_spans(text: Column) -> Column:
    """Valid matches of the fixed patterns, of all kinds."""
    assign = F.filter(matches(text, ASSIGN, text.rlike(WORDS), 0, part=1), lambda s: F.length(s["part"]) >= 8)
    access = F.filter(matches(text, ACCESS, F.contains(text, F.lit("AKIA")), 1), lambda s: F.length(s["value"]) >= 16)
    return merged([slim(assign), slim(access), slim(matches(text, HEX, text.rlike("[0-9a-f]{32}"), 2))])


def _term(n: Column) -> Column:
    return F.when(n > 1, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def highest_entropy(value: Column, window: int) -> Column:
    """Highest entropy in bits of any window of the value (of all of it, if shorter)."""
    chars = F.split(value, "")

    def slide(codes: Column, letters: Column) -> Column:
        """codes: place of each character among the value's different ones, from 1."""

        def step(s: Column, x: Column) -> Column:
            n, full = s["n"], s["n"] >= window
            out = F.when(full, F.element_at(codes, F.greatest(n - window, F.lit(0)) + 1)).otherwise(F.lit(0))
            gone = F.when(full, F.element_at(s["counts"], F.greatest(out, F.lit(1)))).otherwise(F.lit(0))
            had = F.element_at(s["counts"], x) - (out == x).cast("int")
            counts = F.transform(s["counts"], lambda c, i: c + (i + 1 == x).cast("int") - (i + 1 == out).cast("int"))
            total = s["sum"] - _term(gone) + _term(gone - 1) - _term(had) + _term(had + 1)
            size = F.least(n + 1, F.lit(window)).cast("double")
            bits = F.log2(size) - total / size
            enough = (n + 1 >= window) | (n + 1 == F.size(codes))
            best = F.when(enough, F.greatest(s["best"], bits)).otherwise(s["best"])
            return F.struct((n + 1).alias("n"), total.alias("sum"), best.alias("best"), counts.alias("counts"))

        zero = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"),
                        F.transform(letters, lambda _: F.lit(0)).alias("counts"))
        return F.aggregate(codes, zero, step, lambda s: s["best"])

    def coded(cs: Column) -> Column:
        return let(F.array_distinct(cs), lambda letters: let(
            F.transform(cs, lambda c: F.array_position(letters, c).cast("int")), lambda codes: slide(codes, letters)))

    return let(chars, coded)


def _high(value: Column) -> Column:
    """Whether a run, or what fillers leave of it, is a secret by its class."""
    high, earlier = F.lit(False), F.length(value) < 20
    for _, pattern, window, least in CLASSES:
        fits = value.rlike(pattern)
        high = high | (fits & ~earlier & (highest_entropy(value, window) >= least))
        earlier = earlier | fits
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    return ~allowed & high


def _secret(s: Column) -> Column:
    value = s["value"]
    parts = F.split(value, f".{{0,{REACH}}}{FILLERS}.{{0,{REACH}}}", -1)
    return F.when(value.rlike(FILLERS), F.exists(parts, _high)).otherwise(_high(value))


def scan_secrets(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy), a row for each row."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = slim(matches(F.col("text"), CANDIDATE, F.col("text").rlike("[A-Za-z0-9+/_=-]{20}"), 3))
    docs = docs.select("doc_id", base_spans(F.col("text")).alias("base"), found.alias("found"))
    docs = docs.withColumn("more", F.filter("found", lambda s: ~overlaps(s, F.col("base")) & _secret(s)))
    counts = [counted(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:-1])]
    return docs.select("doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                       joined(F.concat("base", "more"), KINDS).alias("spans"), F.size("more").cast("long").alias("n_entropy"))
