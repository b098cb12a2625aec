"""Line dedup: an exact set-similarity join of all lines, which removes every later match.

A line's set is its distinct five-word shingles (its whole word sequence, if shorter). Two lines match
when 100 * intersection >= 75 * union. Lines are ordered by document id, then by a hash of the text,
then by place; a line goes when an earlier line matches it. A document keeps its other lines and those
without words, joined by newlines.

Tokens are ordered by rarity: by how often their slot of a table of fixed size was counted over all
lines, ties by hash. The order is the same for all lines, so prefixes stay exact however slots are
shared. Two similar lines share one of their first n - ceil(0.75 n) + 1 tokens (prefix filter), have
similar lengths (length filter) and enough tokens left after the first common one (positional filter).
A line's parity sketch of 256 bits bounds the rest; sets decide.

Lines of equal sets are one class, found by two 64-bit hashes of the set; only its first line stays.
A class is first compared with the earliest class of the token it shares most often. Only classes that
this leaves unmatched meet the other earlier classes of their tokens, so groups of copies are not
expanded into pairs.

Null or empty texts stay as they are. Rows equal in doc_id and text are one document and treated
alike. A null doc_id comes first in the order. Other columns pass through. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, cut, marked, maybe_in, rows_of_shared_keys, slices, total
from fleetgauge.llm.shingles import fingerprints, grouped, mix, raw, shingle_sets, shingles, sketches, starts_of

#: Similarity in hundredths.
SIMILAR = 75
#: Counters of the rarity table; its size is fixed (2 MB), whatever the input.
SLOTS = 1 << 18
#: 64-bit words of a line's sketch.
FOLD = 4
#: Line classes a task remembers, so that copies in one task are indexed once.
SEEN = 1 << 17
_SKETCH = [f"k{i}" for i in range(FOLD)]
_PLACE = "struct<doc_id:bigint,mark:bigint,line:int>"


def _starts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of the batch, line number) of each line, the bytes of all, and where each line begins."""
    data, at = raw(column(batch, "text"))
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.concatenate([breaks, at[:-1]])
    of_doc = np.concatenate([np.zeros(len(breaks), np.int64), np.ones(len(at) - 1, np.int64)])
    order = np.lexsort((of_doc, starts))  # a text's last empty line comes before the next text
    starts, of_doc = starts[order], of_doc[order]
    row = np.cumsum(of_doc) - 1
    number = np.arange(len(row)) - np.flatnonzero(of_doc)[row] if len(row) else row
    return row, number, data, np.append(starts, len(data))


def _lines(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of the batch, line number) of each line, then (line, hash) of the distinct shingles by line."""
    row, number, data, starts = _starts(batch)
    return row, number, *shingle_sets(data, starts)


def _slot(value: np.ndarray) -> np.ndarray:
    return (mix(value, 13) & np.uint64(SLOTS - 1)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(SLOTS, np.int64)
    for batch in slices(batches, "text"):
        _, _, data, starts = _starts(batch)
        table += np.bincount(_slot(shingles(data, starts)[1]), minlength=SLOTS)
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used])], ["slot", "n"])


def _rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each slot by its count over all lines: SLOTS rows at most come to the driver."""
    rows = cut(docs.mapInArrow(_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))).toArrow()
    table = np.zeros(SLOTS, np.int64)
    table[np.asarray(rows.column("slot"))] = np.asarray(rows.column("n"))
    return (np.log2(table + 1.0) * 1000).astype(np.uint16)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with words."""
    for batch in slices(batches, "text"):
        row, number, segment, value = _lines(batch)
        begins = starts_of(segment, len(row))
        n = np.diff(begins)
        f1, f2 = fingerprints(value, begins)
        full = n > 0
        bits = np.ascontiguousarray(sketches(value, segment, len(row), FOLD)[full].T)
        own = pa.array(row[full])
        values = (number[full].astype(np.int32), n[full].astype(np.int32), f1[full], f2[full], *bits)
        yield pa.RecordBatch.from_arrays(
            [column(batch, "doc_id").take(own), column(batch, "mark").take(own), *(pa.array(v) for v in values)],
            ["doc_id", "mark", "line", "n", "f1", "f2", *_SKETCH],
        )


def _prefixes(table) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(token, class, place in the order) of each prefix token of each class new to the task."""
        seen: dict[int, None] = {}
        for batch in slices(batches, "text"):
            row, _, segment, value = _lines(batch)
            begins = starts_of(segment, len(row))
            n = np.diff(begins)
            f1, _ = fingerprints(value, begins)
            new = n > 0
            for k, f in enumerate(f1.tolist()):
                if new[k]:
                    new[k] = f not in seen
                    seen[f] = None
            while len(seen) > SEEN:
                del seen[next(iter(seen))]
            mine = new[segment]
            line, v = segment[mine], value[mine]
            order = grouped(line, v, table.value[_slot(v)])
            line, v = line[order], v[order]
            place = np.arange(len(line)) - starts_of(line, len(row))[line]
            keep = place < (n - -(-SIMILAR * n // 100) + 1)[line]
            line, v, place = line[keep], v[keep], place[keep]
            values = (marked(v).view(np.int64), f1[line], place.astype(np.int32))
            for lo in range(0, len(line), 1 << 17):
                own = slice(lo, lo + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(x[own]) for x in values], ["key", "f1", "i"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        row, number, segment, value = _lines(batch)
        begins = starts_of(segment, len(row))
        full = np.flatnonzero(np.diff(begins))
        members = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(value.view(np.int64))).take(pa.array(full))
        own = pa.array(row[full])
        place = [column(batch, "doc_id").take(own), column(batch, "mark").take(own), pa.array(number[full].astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*place, members], ["doc_id", "mark", "line", "members"])


def _near(a: str, b: str):
    size = F.expr(f"100 * least({a}n, {b}n) >= {SIMILAR} * greatest({a}n, {b}n)")
    differ = total([F.expr(f"cast(bit_count({a}{k} ^ {b}{k}) as bigint)") for k in _SKETCH])
    return size & (differ * (100 + SIMILAR) <= (100 - SIMILAR) * F.expr(f"{a}n + {b}n"))


def _matched(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Places a of the pairs (a, b) whose sets are similar."""
    pairs = cut(pairs)
    places = pairs.select(F.explode(F.array("a", "b")).alias("place")).distinct()
    wanted = maybe_in(docs, "doc_id", places.select("place.doc_id").distinct())
    sets = wanted.mapInArrow(_sets, "doc_id long, mark long, line int, members array<long>")
    sets = sets.select(F.struct("doc_id", "mark", "line").alias("place"), "members")
    sets = cut(maybe_in(sets, "place", places))
    both = pairs.join(sets.withColumnsRenamed({"place": "a", "members": "ma"}), "a")
    both = both.join(sets.withColumnsRenamed({"place": "b", "members": "mb"}), "b")
    both = both.select("a", F.size(F.array_intersect("ma", "mb")).cast("long").alias("c"), (F.size("ma") + F.size("mb")).alias("s"))
    return both.filter(f"100 * c >= {SIMILAR} * (s - c)").select("a").distinct()


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, mark, gone): the numbers of the lines to remove, for documents that have some."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    docs = docs.filter("text <> ''")
    table = docs.sparkSession.sparkContext.broadcast(_rarity(docs))
    fields = ", ".join(["doc_id long, mark long, line int, n int, f1 long, f2 long", *(f"{k} long" for k in _SKETCH)])
    lines = cut(docs.mapInArrow(_digest, fields))
    place = F.struct("doc_id", "mark", "line").alias("place")
    shape = [F.first(c).alias(c) for c in ("n", *_SKETCH)]
    classes = cut(lines.groupBy("f1", "f2").agg(F.min(place).alias("place"), *shape))

    rows = docs.mapInArrow(_prefixes(table), "key long, f1 long, i int")
    rows = cut(rows_of_shared_keys(rows, "f1"))
    rows = cut(rows.distinct().join(classes.drop("f2"), "f1"))
    first = rows.groupBy("key").agg(F.min("place").alias("low"), F.max("place").alias("high")).filter("low < high")
    rows = cut(rows.join(first.drop("high"), "key"))

    partner = rows.filter("low < place").groupBy("place", "low").agg(F.count("*").alias("times"))
    partner = partner.groupBy("place").agg(F.max_by("low", F.struct("times", F.col("low.mark"))).alias("b"))
    shape = classes.select("place", "n", *_SKETCH)

    def shaped(ids: DataFrame, key: str) -> DataFrame:
        return ids.join(shape.withColumnsRenamed({"place": key, **{c: f"{key}_{c}" for c in ("n", *_SKETCH)}}), key)

    pairs = shaped(shaped(partner.withColumnRenamed("place", "a"), "a"), "b").filter(_near("a_", "b_"))
    gone = cut(_matched(docs, pairs.select("a", "b")))

    left = rows.join(gone.withColumnRenamed("a", "place"), "place", "left_anti").filter("low < place").drop("low")
    one = left.withColumnsRenamed({c: f"a_{c}" for c in left.columns})
    two = rows.drop("low").withColumnsRenamed({c: f"b_{c}" for c in left.columns})
    enough = F.expr(f"{100 + SIMILAR} * (1 + least(a_n - a_i - 1, b_n - b_i - 1)) >= {SIMILAR} * (a_n + b_n)")
    meet = (F.col("a_key") == F.col("b_key")) & (F.col("b_place") < F.col("a_place")) & _near("a_", "b_") & enough
    rest = one.join(two, meet).select(F.col("a_place").alias("a"), F.col("b_place").alias("b")).distinct()
    gone = gone.unionByName(_matched(docs, rest)).withColumnsRenamed({"a": "place"}).withColumn("matched", F.lit(True))

    verdict = classes.select("f1", "f2", "place").join(gone, "place", "left")
    every = lines.select("f1", "f2", place.alias("own")).join(verdict, ["f1", "f2"])
    every = every.filter("matched or own <> place").select("own.*")
    return every.groupBy("doc_id", "mark").agg(F.collect_set("line").alias("gone"))


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with repeated lines taken out of their texts, and n_removed (long)."""
    gone = repeated_lines(documents)
    kept = [c for c in documents.columns if c != "n_removed"]
    packed = documents.select(*kept).withColumn("n_removed", F.lit(0).cast("long"))
    names = packed.schema
    packed = packed.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("own"))
    gone = cut(gone.withColumnsRenamed({"doc_id": "gone_id"}))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("own") == F.col("mark")) & F.col("row.text").isNotNull()
    joined = packed.join(gone, same, "left").select("row.*", F.col("gone").alias("__gone"))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, removed = [], []
            for text, lines in zip(column(batch, "text").to_pylist(), column(batch, "__gone").to_pylist(), strict=True):
                if lines:
                    out = set(lines)
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out)
                texts.append(text)
                removed.append(len(lines or ()))
            values = {n: column(batch, n) for n in names.names}
            values |= {"text": pa.array(texts, column(batch, "text").type), "n_removed": pa.array(removed, pa.int64())}
            yield pa.RecordBatch.from_arrays([values[n] for n in names.names], names.names)

    return joined.mapInArrow(rest, names)
