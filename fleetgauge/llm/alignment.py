"""Alignment of two tokenizers: where tokens of both end at the same byte, and which id pairs that links.

Within a task everything is Arrow: ids of a slice of documents are lists, flattened, with the parent of each;
a cumulative sum of token sizes, less its value at the document's start, gives each token's end. Ends of
both sides meet in a hash join (Acero) on the key (document, end). A match links the two tokens that end there and closes a
group, so groups are numbered by a cumulative sum of matches. Table.group_by counts the slice's id pairs;
counts are added up over a block of documents, and Spark adds up the blocks.

A document's links need the totals of their pairs. They are written once, each as the number of its pair in the block.
Each block gets the totals of its own pairs back, one row a pair and block, and reads them before its documents:
no link is shuffled by its pair, so a pair that every document has costs a row a block. A block's documents are
dealt together; a block has BLOCK bytes of text, or one text that is longer.

Documents without text, or whose tokens do not spell ' ' + text on both sides, have no tokens: zeros
and an empty digest. Long texts are encoded in pieces cut where no token reaches across (tokenizer_files); ids and
links of one text are held together, a few bytes a token. doc_id may repeat or be null: a row gives a
row. Other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, cut, slices
from fleetgauge.llm.tokenizer_files import Encoder, SharedFile

#: Bytes of text whose pair counts are added up in a task before they leave it; rows of counts or links held at once.
BLOCK, HELD = 64 << 20, 1 << 20
#: Bits of a byte offset inside a document in the join key.
OFFSET = 40
#: The join's key, and the token's number on its side.
_KEY, _ROW = "key", "row"


class Side:
    """One tokenizer: its encoder, the bytes of its tokens and their sizes."""

    def __init__(self, encoder: Encoder):
        self.encoder, spelled = encoder, encoder.token_bytes()
        self.bytes = pa.array(spelled, pa.large_binary())
        self.sizes = pa.array(np.fromiter(map(len, spelled), np.int64, len(spelled)))


class Ends:
    """Tokens of a slice of documents on one side: flat ids, parents, ends inside the document."""

    def __init__(self, side: Side, lists: list[list[int]]):
        rows = pa.array(lists, pa.list_(pa.int32()))
        self.ids, self.parent = pc.list_flatten(rows), pc.cast(pc.list_parent_indices(rows), pa.int64())
        self.counts = np.asarray(pc.list_value_length(rows)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        sizes = np.concatenate([[0], np.asarray(pc.cumulative_sum(side.sizes.take(self.ids)))]).astype(np.int64)
        self.bounds = sizes[self.starts]  # the documents' bytes in all bytes of the slice
        self.ends = pa.array(sizes[1:] - self.bounds[np.asarray(self.parent)])
        self.side = side

    def keys(self) -> pa.Table:
        key = pc.bit_wise_or(pc.shift_left(self.parent, OFFSET), self.ends)
        return pa.table({_KEY: key, _ROW: pa.array(np.arange(len(key)))})

    def spelled(self) -> Iterator[bytes]:
        """The joined token bytes of each document."""
        view = memoryview(self.side.bytes.take(self.ids).buffers()[2] or b"")
        return (bytes(view[a:b]) for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True))


class Aligned:
    """Links and groups of a slice of documents."""

    def __init__(self, a: Side, b: Side, texts: list[str]):
        lists_a, lists_b = a.encoder.encoded([t and " " + t for t in texts]), b.encoder.encoded(texts)
        self.a, self.b = Ends(a, lists_a), Ends(b, lists_b)
        wrong = [
            i
            for i, (t, x, y) in enumerate(zip(texts, self.a.spelled(), self.b.spelled(), strict=True))
            if t and not x == y == (" " + t).encode()
        ]
        if wrong:
            for i in wrong:
                lists_a[i], lists_b[i] = [], []
            self.a, self.b = Ends(a, lists_a), Ends(b, lists_b)
        self._join()

    def _join(self) -> None:
        found = self.a.keys().join(self.b.keys(), _KEY, join_type="inner", right_suffix="_b", use_threads=False)
        at, other = (np.asarray(found[c].combine_chunks()) for c in (_ROW, f"{_ROW}_b"))
        mate = np.full(len(self.a.ids), -1, dtype=np.int64)
        mate[at] = other
        self.link_a = np.flatnonzero(mate >= 0)
        self.link_b = mate[self.link_a]
        self.n_links = np.bincount(np.asarray(self.a.parent)[self.link_a], minlength=len(self.a.counts))

    def pairs(self, width: int) -> np.ndarray:
        """The linked ids in order, a * width + b."""
        a, b = (np.asarray(side.ids).astype(np.int64)[at] for side, at in ((self.a, self.link_a), (self.b, self.link_b)))
        return a * width + b

    def digests(self, words: pa.LargeStringArray) -> list[str]:
        """SHA-256 of each document's groups, ids in decimal; words: see _words()."""
        n_a, n_b = len(self.a.ids), len(self.b.ids)
        closes_a, closes_b = np.zeros(n_a + 1, bool), np.zeros(n_b + 1, bool)
        closes_a[self.link_a + 1], closes_b[self.link_b + 1] = True, True  # the token before closed a group
        group_a, group_b = np.cumsum(closes_a[:-1]), np.cumsum(closes_b[:-1])
        # A's tokens of a group stand behind B's of all groups before it, B's behind A's of this group too.
        behind_b = np.concatenate([[0], self.link_b + 1])
        behind_a = np.concatenate([self.link_a + 1, [n_a]])
        first = np.zeros(n_a + 1, bool)
        first[self.a.starts[:-1]] = True
        first_b = closes_b[:-1].copy()
        first_b[:1] = True
        ahead_a = np.where(first[:-1], 2, closes_a[:-1].astype(np.int64))
        size_a, size_b = len(self.a.side.sizes), len(self.b.side.sizes)
        order = np.empty(n_a + n_b, dtype=np.int64)
        order[np.arange(n_a) + behind_b[group_a]] = ahead_a * size_a + np.asarray(self.a.ids)
        order[np.arange(n_b) + behind_a[group_b]] = 3 * size_a + first_b * size_b + np.asarray(self.b.ids)
        line = words.take(pa.array(order))
        offsets = np.frombuffer(line.buffers()[1], dtype=np.int64, count=len(order) + 1) if len(order) else np.zeros(1, np.int64)
        edges = offsets[self.a.starts + self.b.starts].tolist()
        view = memoryview(line.buffers()[2]) if len(order) else memoryview(b"")
        return [hashlib.sha256(view[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(edges, edges[1:], strict=False)]


def _words(size_a: int, size_b: int) -> pa.LargeStringArray:
    """Ids in decimal behind each mark that may precede them: ',' ';' or nothing for A, ',' '|' for B."""
    marks = [(",", size_a), (";", size_a), ("", size_a), (",", size_b), ("|", size_b)]
    return pa.array([f"{mark}{i}" for mark, size in marks for i in range(size)], pa.large_string())


@lru_cache(maxsize=2)
def _sides(a: Encoder, b: Encoder) -> tuple[Side, Side, pa.LargeStringArray]:
    one, two = Side(a), Side(b)
    return one, two, _words(len(one.sizes), len(two.sizes))


class _Pairs:
    """The id pairs of a block in order of first sight, and how often each was linked."""

    def __init__(self) -> None:
        self.known, self.parts = pa.array([], pa.int64()), []

    def add(self, pairs: np.ndarray) -> pa.Array:
        """Count pairs; their numbers in the block."""
        rows = pa.array(pairs)
        new = pc.unique(rows)
        new = new.filter(pc.invert(pc.is_in(new, value_set=self.known)))
        self.known = pa.concat_arrays([self.known, new])
        number = pc.index_in(rows, value_set=self.known)
        self.parts.append(pa.table({"number": number}).group_by("number", use_threads=False).aggregate([([], "count_all")]))
        if len(self.parts) > 1 and sum(p.num_rows for p in self.parts) > HELD:
            self.parts = [self._total()]
        return number

    def _total(self) -> pa.Table:
        rows = pa.concat_tables(self.parts).group_by("number", use_threads=False).aggregate([("count_all", "sum")])
        return rows.rename_columns(["number", "count_all"])

    def counts(self) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(number, pair, count)."""
        total = self._total()
        number = total["number"].combine_chunks()
        return number, self.known.take(number), total["count_all"].combine_chunks()


_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def linked_documents(documents: DataFrame, a: str, b: str) -> DataFrame:
    """Two kinds of rows: documents (block, _DOC, links), and the pairs of their block (block, number, pair, n).

    A link is the number of its pair in the block; a pair is a * width + b, with the size of b's vocabulary as
    width. Written to the shared folder.
    """
    spark = documents.sparkSession
    file_a, file_b = SharedFile(spark, a, plain=True), SharedFile(spark, b, plain=True)
    schema = f"block long, number int, pair long, n long, {_DOC}, links array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, words = _sides(file_a.encoder(), file_b.encoder())
        block, size, pairs = TaskContext.get().partitionId() << 32, 0, _Pairs()
        for batch in slices(batches, "text"):
            texts = column(batch, "text").to_pylist()
            found = Aligned(one, two, [t or "" for t in texts])
            numbers = pairs.add(found.pairs(len(two.sizes)))
            yield _doc_rows(block, column(batch, "doc_id"), found, numbers, words)
            size += sum(len(t) for t in texts if t)
            if size >= BLOCK:
                yield _pair_rows(block, pairs)
                block, size, pairs = block + 1, 0, _Pairs()
        if pairs.parts:
            yield _pair_rows(block, pairs)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(docs.mapInArrow(run, schema))


_NAMES = ["block", "number", "pair", "n", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]


def _doc_rows(block: int, doc_ids: pa.Array, found: Aligned, numbers: pa.Array, words: pa.LargeStringArray) -> pa.RecordBatch:
    n = len(doc_ids)
    offsets = np.concatenate([[0], np.cumsum(found.n_links)]).astype(np.int32)
    arrays = [
        pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.int64())] * 2, doc_ids,
        *(pa.array(c) for c in (found.a.counts, found.b.counts, found.n_links, found.n_links)),
        pa.array(found.digests(words), pa.string()), pa.ListArray.from_arrays(pa.array(offsets), numbers),
    ]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _pair_rows(block: int, pairs: _Pairs) -> pa.RecordBatch:
    counts = pairs.counts()
    n = len(counts[0])
    arrays = [
        pa.array(np.full(n, block)), *counts, *[pa.nulls(n, pa.int64())] * 5, pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def pair_totals(found: DataFrame, width: int) -> DataFrame:
    """(pair, total, best) over all documents; best: no pair with the same b has more links."""
    totals = cut(found.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("total")))
    b = (F.col("pair") % width).alias("b")
    most = totals.groupBy(b).agg(F.max("total").alias("most"))  # one row for each id of b's vocabulary at most
    marked = totals.withColumn("b", b).join(F.broadcast(most), "b")
    return marked.select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block: its pairs' totals by number, then its documents, whose links look them up."""
    at, held, table = None, [], None
    for batch in batches:
        blocks = np.asarray(column(batch, "block"))
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if hi == lo:
                continue
            if blocks[lo] != at:
                at, held, table = blocks[lo], [], None
            rows = batch.slice(lo, hi - lo)
            n_pairs = len(rows) - column(rows, "number").null_count  # pairs come first
            if n_pairs:
                held.append([np.asarray(column(rows, c).slice(0, n_pairs).cast(pa.int64())) for c in ("best", "total")])
            docs = rows.slice(n_pairs)
            if len(docs) and table is None:
                table = [np.concatenate([np.zeros(0, np.int64), *(h[i] for h in held)]) for i in range(2)]
            yield from (_scored(part, table) for part in _parts(docs))


def _parts(docs: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The documents in parts of about HELD links, one document at least."""
    sizes = np.asarray(pc.list_value_length(column(docs, "links"))).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // HELD
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(docs)]
    return (docs.slice(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False) if hi > lo)


def _scored(docs: pa.RecordBatch, table: list[np.ndarray]) -> pa.RecordBatch:
    links = column(docs, "links")
    flat, starts = np.asarray(pc.list_flatten(links)), np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(links)))])
    sums = []
    for values in table:
        run = np.concatenate([[0], np.cumsum(values[flat])])
        sums.append(pa.array(run[starts[1:]] - run[starts[:-1]]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    arrays = [*(column(docs, c) for c in names), *sums, column(docs, "groups_sha256")]
    return pa.RecordBatch.from_arrays(arrays, [*names, "n_best", "count_sum", "groups_sha256"])


def align_documents(documents: DataFrame, a: str, b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each document; a, b: tokenizer files."""
    width = SharedFile(documents.sparkSession, b).encoder().size()
    found = linked_documents(documents, a, b)
    own = found.filter("pair is not null").select("block", "number", "pair").join(pair_totals(found, width), "pair").drop("pair")
    docs = found.filter("pair is null").drop("pair", "n")
    names = [c for c in docs.columns if c not in ("block", "number")]
    empty = {c: F.lit(None).cast(docs.schema[c].dataType) for c in names}
    rows = own.withColumns(empty).unionByName(docs.withColumns({"total": F.lit(None).cast("long"), "best": F.lit(None).cast("boolean")}))
    dealt = rows.repartition("block").sortWithinPartitions("block", F.col("number").asc_nulls_last())
    return dealt.mapInArrow(
        _sums, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
