"""Language identification: text, declared language, address suffix and host, fused by Bayes' rule.

Text likelihood: hashed byte trigrams of the lower-cased text, one multinomial per declared language, fitted on a
bounded sample of labelled documents (PER_LANGUAGE documents a language, the first SAMPLE_CHARS characters of
each). Spellings of a label (en, EN, en-US) are one language, named by the commonest. Memory bounds the
languages to LANGUAGES; rows whose label has no class, beyond these or without any text, are never rejected
and keep their label as the language, with confidence 0. A class 'und' spreads evenly over all trigrams: text that no language
explains better than that. Neighbouring trigrams overlap, so the sum is tempered by TEMPER.

Declared language (a document's label or a page's markup): P(declared | language) from the counts of
both over all rows. Host prior, smoothed hierarchically: host counts lean on those of the address
suffix, these on those of all rows, each with the weight of STRENGTH rows. Counts are of the
languages that the text alone gives, by grouped aggregation over all rows; a host without any has its suffix's shares.

A row is kept unless 'und' or no language at all is the likelier half. Null or empty text: no text evidence,
the rest decides. Null declared language, suffix or host: no such evidence (a null host is counted with the
other null hosts of its suffix). Without any labelled row nothing is identified and nothing
rejected: language null, confidence 0, kept. Repeated rows get equal results. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, cut, slices
from fleetgauge.llm.shingles import folded, raw

#: Bounds of the sample the model is fitted on.
PER_LANGUAGE, LANGUAGES, SAMPLE_CHARS = 250, 1024, 20_000
#: Trigram slots, and what each is counted beforehand.
SLOTS, PRIOR = 1 << 16, 0.3
#: Weight of a trigram's log likelihood, rows that a parent level counts for, share of 'und'.
TEMPER, STRENGTH, UNKNOWN = 0.15, 20.0, 0.002
#: Least posterior probability of a kept row.
KEEP = 0.5


def _trigrams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams of letters and single spaces, and where each text begins."""
    data, at = raw(column(batch, "text"))
    letter = ((data >= 97) & (data <= 122)) | (data >= 128)
    low = np.where(letter, data, 32).astype(np.uint64)
    n = len(data)
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    slot = (low[:-2] * np.uint64(0x9E3779B1) + low[1:-1] * np.uint64(0x85EBCA77) + low[2:] * np.uint64(0xC2B2AE3D))
    slot = ((slot ^ (slot >> np.uint64(15))) * np.uint64(0x2C1B3C6D) >> np.uint64(8)) & np.uint64(SLOTS - 1)
    good = letter[1:-1] & (letter[:-2] | letter[2:])
    inner = at[(at > 0) & (at < n)]
    for back in (1, 2):  # no trigram across two texts
        edge = inner - back
        good[edge[(edge >= 0) & (edge < n - 2)]] = False
    where = np.flatnonzero(good)
    return slot[where].astype(np.int64), np.searchsorted(where, at)


def _labels(rows: DataFrame) -> DataFrame:
    """(declared, label): the language of each spelling, for the LANGUAGES languages with most rows."""
    plain = F.lower(F.trim("declared"))
    tag = F.regexp_extract(plain, r"^([a-z]{2,3})[-_](?:[a-z]{4}|[a-z]{2}|[0-9]{3})(?:[-_].*)?$", 1)
    said = cut(rows.filter("declared is not null").groupBy("declared").agg(F.count("*").alias("n")).withColumn("key", F.coalesce(F.nullif(tag, F.lit("")), plain)))
    names = said.groupBy("key").agg(F.min(F.struct(-F.col("n"), "declared"))["declared"].alias("label"), F.sum("n").alias("rows"))
    names = names.orderBy(F.desc("rows"), "label").limit(LANGUAGES)
    return cut(said.join(F.broadcast(names), "key").select("declared", "label"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, slot, n): trigrams of each slice's texts."""
    for batch in slices(batches, "text"):
        for label in column(batch, "label").unique():
            slot, _ = _trigrams(batch.filter(pc.equal(column(batch, "label"), label)))
            found, n = np.unique(slot, return_counts=True)
            if not len(found):  # the language has a class all the same
                found, n = np.zeros(1, np.int64), np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([label.as_py()] * len(found)), pa.array(found), pa.array(n)], ["label", "slot", "n"])


def _sampled(rows: DataFrame) -> DataFrame:
    """(label, text): the bounded sample, the same on each run."""
    fit = rows.filter("label is not null and length(text) > 0").withColumn("order", F.xxhash64("doc_id", "text"))
    ids = fit.select("label", "order")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order"))
    ids = cut(ids.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).drop("rank").distinct())
    return fit.join(F.broadcast(ids), ["label", "order"]).select("label", F.substring("text", 1, SAMPLE_CHARS).alias("text")).distinct()


def fit(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log likelihood of each trigram slot by language, 'und' last, from (doc_id, text, label)."""
    # a language's sample is bounded and meets in one task, so that its slots are counted once, not once a partition
    found = _sampled(rows).repartition("label").mapInArrow(_counted, "label string, slot long, n long").groupBy("label", "slot").agg(F.sum("n").alias("n")).toArrow()
    labels = sorted(found.column("label").unique().to_pylist())
    which = np.asarray(pc.index_in(found.column("label"), pa.array(labels, pa.string())).combine_chunks()) if labels else []
    table = np.full((SLOTS, len(labels) + 1), PRIOR, np.float32)
    table[:, -1] = 1.0
    table[np.asarray(found.column("slot")), which] += np.asarray(found.column("n")) if labels else 0
    sums = table.sum(axis=0, dtype=np.float64)
    np.log(table, out=table)
    table -= np.log(sums).astype(np.float32)
    return labels, table


def _log_shares(counts: Column, size: Column, parent: Column) -> Column:
    """Shares of counts, leaning on the parent's shares with the weight of STRENGTH rows."""
    return F.zip_with(counts, parent, lambda c, p: (c + STRENGTH * p) / (size + STRENGTH))


def identify(rows: DataFrame) -> DataFrame:
    """(doc_id, declared, language, confidence, kept) for rows (doc_id, text, declared, suffix, host).

    Fitted on these rows' own declared languages.
    """
    rows = rows.select("doc_id", F.lower("text").alias("text"), "declared", "suffix", "host")
    rows = rows.join(_labels(rows), "declared", "left")  # spellings may be many: no hint, the cut's size decides
    labels, table = fit(rows)
    if not labels:
        none = (F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(True).alias("kept"))
        return rows.select("doc_id", "declared", *none)
    shared = rows.sparkSession.sparkContext.broadcast(table)
    width = len(labels) + 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tempered log likelihoods, and the class that the text alone gives (-1: no text)."""
        for batch in slices(batches, "text"):
            slot, at = _trigrams(batch)
            sums = np.stack([folded(shared.value[slot, k].astype(np.float64), np.add, at) for k in range(width)], axis=1)
            best = np.where(np.diff(at) > 0, sums.argmax(axis=1), -1)
            flat = pa.array((sums * TEMPER).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, batch.num_rows * width + 1, width, dtype=np.int32)), flat)
            names = ["doc_id", "declared", "label", "suffix", "host"]
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), lists, pa.array(best.astype(np.int32))], [*names, "likely", "best"])

    fields = "doc_id long, declared string, label string, suffix string, host string, likely array<double>, best int"
    scored = rows.mapInArrow(score, fields)
    scored = cut(scored)
    told = scored.filter("best >= 0")

    # P(declared | language): a table of languages squared at most, declared values beyond the labels as one
    seen = told.groupBy("best", F.col("label").alias("d")).agg(F.count("*").alias("n")).collect()
    says, place = np.full((width, width), 0.5), {label: k for k, label in enumerate(labels)}
    for r in seen:
        says[r.best, place.get(r.d, width - 1)] += r.n
    says = np.log(says / says.sum(axis=1, keepdims=True))
    says[-1, :-1] = says[:-1, :-1].max(axis=0)  # a label is no sign against 'und'

    def vector(keys: list[str], counted: DataFrame) -> DataFrame:
        """(keys, counts, size): rows by language, from (keys, best, n)."""
        got = counted.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"), F.sum("n").alias("size"))
        at = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.coalesce(F.element_at("m", k), F.lit(0)).cast("double"))
        return got.select(*keys, at.alias("counts"), F.col("size").cast("double").alias("size"))

    # hosts whose rows all lack text count nothing, and so get the shares of their suffix
    told_n = F.sum((F.col("best") >= 0).cast("long")).alias("n")
    counted = cut(scored.groupBy("suffix", "host", "best").agg(told_n))
    everything = np.zeros(width)
    for r in counted.groupBy("best").agg(F.sum("n").alias("n")).collect():
        everything[r.best] = r.n
    overall = (everything + 1) / (everything.sum() + width)
    overall[-1] = UNKNOWN
    overall /= overall.sum()
    whole = F.array(*(F.lit(float(x)) for x in overall))
    by_suffix = vector(["suffix"], counted.groupBy("suffix", "best").agg(F.sum("n").alias("n")))
    by_suffix = by_suffix.select(F.col("suffix").alias("s"), _log_shares(F.col("counts"), F.col("size"), whole).alias("up"))
    same = F.col("suffix").eqNullSafe(F.col("s"))
    shares = _log_shares(F.col("counts"), F.col("size"), F.col("up"))
    priors = vector(["suffix", "host"], counted).join(by_suffix, same).select(F.col("host").alias("h"), "s", shares.alias("prior"))

    out = scored.join(cut(priors), same & F.col("host").eqNullSafe(F.col("h")), "left")
    by_label = pa.table({"label": pa.array(labels, pa.string()), "declares": pa.array(says[:, :-1].T.tolist(), pa.list_(pa.float64()))})
    out = out.join(F.broadcast(rows.sparkSession.createDataFrame(by_label)), "label", "left")
    declared = F.coalesce("declares", F.array(*[F.lit(0.0)] * width))
    log_prior = F.transform(F.coalesce("prior", whole), lambda p: F.log(p))
    fused = F.zip_with(F.zip_with("likely", log_prior, lambda x, y: x + y), declared, lambda x, y: x + y)
    out = out.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    mass = F.aggregate(F.transform("fused", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    names = F.array(*(F.lit(x) for x in [*labels, "und"]))
    out = out.withColumn("language", F.element_at(names, F.array_position("fused", F.col("top")).cast("int")))
    out = out.withColumn("confidence", F.round(1 / mass, 6))
    unfitted = F.col("declared").isNotNull() & F.col("declares").isNull()
    kept = unfitted | (F.col("language") != "und") & (F.col("confidence") >= KEEP)
    language = F.when(unfitted, F.col("declared")).otherwise(F.col("language"))
    confidence = F.when(unfitted, 0.0).otherwise(F.col("confidence"))
    return out.select("doc_id", "declared", language.alias("language"), confidence.alias("confidence"), kept.alias("kept"))


def document_rows(documents: DataFrame) -> DataFrame:
    """Documents: lang is the declared language, source the host; they have no address suffix."""
    null = F.lit(None).cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").alias("declared"),
                            null.alias("suffix"), F.col("source").alias("host"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Pages: language of the markup, host and its last label from the address, text between tags."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    said = F.lower(F.regexp_extract("html", r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    # each alternative takes what it has read with it, so broken markup costs no second reading
    hidden = r"(?i)<(script|style)\b(?:[^<]++|<(?!/\1\b))*+|<!--(?:[^-]++|-(?!->))*+|<[^<>]*+>"
    bare = F.regexp_replace("html", hidden, " ")
    return pages.select(F.col("page_id").cast("long").alias("doc_id"), bare.alias("text"), F.nullif(said, F.lit("")).alias("declared"),
                        F.nullif(F.regexp_extract(host, r"([^.]+)$", 1), F.lit("")).alias("suffix"), F.nullif(host, F.lit("")).alias("host"))


def identify_tables(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """(table, doc_id, page_id, declared, language, confidence, kept): both tables, each with a model and priors of its own.

    Documents have a source as host and no suffix; pages have markup, host and suffix. The id of the other table is null.
    """
    null = F.lit(None).cast("long")
    rest = ("declared", "language", "confidence", "kept")
    docs = identify(document_rows(documents)).select(F.lit("documents").alias("table"), "doc_id", null.alias("page_id"), *rest)
    found = identify(page_rows(pages)).select(F.lit("pages").alias("table"), null.alias("doc_id"), F.col("doc_id").alias("page_id"), *rest)
    return docs.unionByName(found)


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those that identify() rejects (rows of one doc_id go together)."""
    bad = identify(document_rows(documents)).filter("not kept").select(F.col("doc_id").alias("bad_id")).distinct()
    bad = cut(bad)  # its size is known when the join is planned, so the texts need no shuffle if it is small
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]), "left_anti")
