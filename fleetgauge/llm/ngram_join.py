"""Near-duplicate documents: an exact Jaccard join on five-word shingles through parity sketches.

Each shingle flips one bit of a document's sketch, so sketches differ in no more bits than the sets
differ in members. Documents with similarity s have a symmetric difference of (1 - s) / (1 + s) of
their summed sizes at most. Cut the sketch into more blocks than that and some blocks agree
(pigeonhole). The full sketch, 2 ** 64 bits wide, is only kept per block, as a hash of the bits set;
a folded one of 1024 bits gives the Hamming bound for pairs that share a block.

Size bands grow by 4 / 3: a pair's larger set is in the smaller one's band or the next. So each
document goes to two groups, and a group's block count follows from its largest possible pair.

No group of copies is ever expanded into its pairs. First each document is verified against one
other, the smallest of the block it shares most often with; the links found make components.
Then only documents of different components that share a block are compared. Blocks are more than
needed, by three in ten; so a document may leave out that many blocks and still lose no link. It
leaves out empty ones and those that more than HOT documents share, unless there are more than it
may; what it could have left out beyond these, a similar document must share as well. Where too many blocks are empty, the document is dealt out once more by another hash: the pair
is found at the first hash at which either document has few empty blocks. After the last hash, the
empty blocks are kept as well, so the join stays exact.

Equal sets are linked outright, by two 64-bit hashes of the set. Rows with the same doc_id count as
one document, with the links of each. A null or empty text, or one without words, has an
empty set and no link. A null doc_id keeps its row, without links. Other columns are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, components, cut, marked, maybe_in, rows_of_shared_keys, slices, total
from fleetgauge.llm.shingles import fingerprints, folded, mix, raw, shingle_sets, sketches, starts_of

#: Similarity in hundredths: 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: 64-bit words of the folded sketch.
FOLD = 16
#: Documents that may share a block before it counts as hot.
HOT = 64
#: Fingerprints a task remembers, so that copies in one task are blocked once.
SEEN = 1 << 16
#: Hashes by which a document is dealt out at most.
DEALS = 8
#: Low bits of a block's key: two marks, the number of the hash, the size band. Bits of its hash: fewer lie in less space.
LOW, HASH = 12, 40
#: First partners are looked for in one of so many blocks, and in all blocks of sets below that size.
SOME, SMALL = 8, 100
_SKETCH = [f"k{i}" for i in range(FOLD)]
#: The sketch folded once more, which goes along where rows of blocks meet.
BRIEF = 4
_BRIEF = [f"h{i}" for i in range(BRIEF)]


def bands(top: int = 1 << 40) -> list[int]:
    """Where size bands begin; each is 4 / 3 of the one before, and the first ones are single sizes."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, out[-1] * 100 // SIMILAR))
    return out


_BANDS = np.array(bands())


def needed_blocks(band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, blocks that may be left out) of the group of pairs whose smaller set is in this band.

    A pair (a, b), a <= b, differs in (a + b - 2 * i) members, i >= SIMILAR / (100 + SIMILAR) * (a + b),
    and b <= 100 / SIMILAR * a, where a ends before the next band.
    """
    a = _BANDS[band + 1] - 1
    both = a + a * 100 // SIMILAR
    differ = both - 2 * (-(-SIMILAR * both // (100 + SIMILAR)))
    spare = -(-differ * 3 // 10)
    return differ + 1 + spare, spare


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, at = raw(column(batch, "text"))
        segment, value = shingle_sets(data, at)
        begins = starts_of(segment, batch.num_rows)
        f1, f2 = fingerprints(value, begins)
        rows = np.ascontiguousarray(sketches(value, segment, batch.num_rows, FOLD).T)
        values = [pa.array(v) for v in (np.diff(begins), f1, f2, *rows)]
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *values], ["doc_id", "n", "f1", "f2", *_SKETCH])


def _dealings(segment: np.ndarray, value: np.ndarray, take: np.ndarray, sizes: np.ndarray):
    """For both groups of each document taken, hash by hash: what _dealt() gives, and the group's number."""
    own = np.searchsorted(_BANDS, sizes, side="right") - 1
    for band in (own, own - 1):
        blocks, spare = needed_blocks(np.maximum(band, 0))
        left = take & (band >= 0)
        for deal in range(DEALS):
            if left.any():
                key, doc, may, left = _dealt(segment, value, left, band, blocks, spare, deal, deal == DEALS - 1)
                grp = band[doc] * DEALS + deal
                yield (key >> np.uint64(64 - HASH) << np.uint64(LOW)) + (grp.astype(np.uint64) << np.uint64(2)), doc, may, grp


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id) for each block with bits; sets that the task has seen lately are left out."""
    seen: OrderedDict[tuple[int, int], None] = OrderedDict()
    for batch in slices(batches, "text"):
        data, at = raw(column(batch, "text"))
        segment, value = shingle_sets(data, at)
        begins = starts_of(segment, batch.num_rows)
        sizes = np.diff(begins)
        new = np.zeros(batch.num_rows, bool)
        for i, f in enumerate(zip(*(x.tolist() for x in fingerprints(value, begins)), strict=True)):
            new[i] = sizes[i] > 0 and f not in seen
            if new[i]:
                seen[f] = None
                if len(seen) > SEEN:
                    seen.popitem(last=False)
        ids = np.asarray(column(batch, "doc_id"))
        for key, doc, _, _ in _dealings(segment, value, new, sizes):
            key = marked(key)
            for lo in range(0, len(doc), 1 << 17):
                own = slice(lo, lo + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(key[own].view(np.int64)), pa.array(ids[doc[own]])], ["key", "doc_id"])


def _spares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, grp, spare): shared blocks that a document may leave out of a group."""
    for batch in slices(batches, "text"):
        data, at = raw(column(batch, "text"))
        segment, value = shingle_sets(data, at)
        sizes = np.diff(starts_of(segment, batch.num_rows))
        ids = np.asarray(column(batch, "doc_id"))
        for _, doc, may, grp in _dealings(segment, value, sizes > 0, sizes):
            doc, first = np.unique(doc, return_index=True)
            grp = grp[first]
            values = (ids[doc], grp.astype(np.int32), may[doc].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["doc_id", "grp", "spare"])


def _dealt(segment, value, take, band, blocks, spare, deal: int, last: bool):
    """(key, document) of each block with bits; by document, the shared blocks it may leave out and whether too many were empty."""
    mine = take[segment]
    doc, v = segment[mine], value[mine]
    block = (mix(v, 51 + deal) % blocks[doc].astype(np.uint64)).astype(np.int64)
    order = np.argsort((doc.astype(np.uint64) << np.uint64(40)) | block.astype(np.uint64))
    doc, block, v = doc[order], block[order], v[order]
    edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (block[1:] != block[:-1])])
    bits = folded(mix(v, 77), np.bitwise_xor, np.r_[edge, len(doc)])
    doc, block = doc[edge], block[edge]
    empty = blocks - np.bincount(doc, minlength=len(take))
    left = take & (empty > spare)
    if last and left.any():
        at = np.flatnonzero(left)
        owner = np.repeat(at, blocks[at])
        every = np.arange(len(owner)) - np.repeat(np.cumsum(blocks[at]) - blocks[at], blocks[at])
        full = np.isin((owner << 32) + every, (doc << 32) + block)
        doc, block = np.r_[doc, owner[~full]], np.r_[block, every[~full]]
        bits = np.r_[bits, np.zeros((~full).sum(), np.uint64)]
        empty = np.where(left, 0, empty)
    group = ((block * DEALS + deal) * 256 + band[doc]).astype(np.uint64)
    return mix(bits + mix(group, 91)), doc, spare - empty, left


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, at = raw(column(batch, "text"))
        segment, value = shingle_sets(data, at)
        begins = starts_of(segment, batch.num_rows).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(begins), pa.array(value.view(np.int64)))
        yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), sets], ["doc_id", "members"])


def _near(a: str, b: str, sketch: list[str] = _SKETCH):
    """Sizes and folded sketches of columns with these prefixes allow the similarity."""
    size = F.expr(f"100 * least({a}n, {b}n) >= {SIMILAR} * greatest({a}n, {b}n)")
    differ = total([F.expr(f"cast(bit_count({a}{k} ^ {b}{k}) as bigint)") for k in sketch])
    return size & (differ * (100 + SIMILAR) <= (100 - SIMILAR) * F.expr(f"{a}n + {b}n"))


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets are similar, by the sets themselves."""
    pairs = cut(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = maybe_in(docs.filter("doc_id is not null"), "doc_id", ids)
    sets = cut(wanted.mapInArrow(_sets, "doc_id long, members array<long>"))
    one = sets.withColumnsRenamed({"doc_id": "a", "members": "ma"})
    two = sets.withColumnsRenamed({"doc_id": "b", "members": "mb"})
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("ma", "mb")).cast("long")
    both = both.select("a", "b", common.alias("i"), (F.size("ma") + F.size("mb")).alias("s"))
    return both.filter(f"100 * i >= {SIMILAR} * (s - i)").select("a", "b").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of documents(doc_id, text)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fields = ", ".join(f"{k} long" for k in ("doc_id", "n", "f1", "f2", *_SKETCH))
    digest = cut(docs.mapInArrow(_digest, fields))
    sets = digest.filter("n > 0 and doc_id is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("node"))
    digest = cut(digest.join(sets, ["f1", "f2"], "left").drop("f1", "f2"))
    nodes = digest.filter("node is not null").select("doc_id", "node")
    known = docs.filter("doc_id is not null")
    rows = cut(rows_of_shared_keys(known.mapInArrow(_blocks, "key long, doc_id long"), "doc_id"))
    shape = digest.filter("node is not null").select("doc_id", "n", *_SKETCH)

    def shaped(ids: DataFrame, key: str, prefix: str) -> DataFrame:
        own = shape.withColumnsRenamed({c: f"{prefix}{c}" for c in shape.columns if c != "doc_id"})
        return ids.join(own.withColumnRenamed("doc_id", key), key)

    # one partner for each document: the smallest of the block it shares most often
    small = int(np.searchsorted(_BANDS, SMALL)) * DEALS
    grp = F.shiftright(F.col("key").bitwiseAND(F.lit((1 << LOW) - 1)), 2)
    some = rows.filter((grp < small) | (F.pmod(F.shiftrightunsigned("key", LOW), F.lit(SOME)) == 0))
    low = some.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high")
    partner = some.join(low, "key").filter("doc_id > low").groupBy("doc_id", "low").agg(F.count("*").alias("times"))
    partner = partner.groupBy("doc_id").agg(F.max_by("low", F.struct("times", -F.col("low"))).alias("b"))
    pairs = shaped(shaped(partner.withColumnRenamed("doc_id", "a"), "a", "a_"), "b", "b_")
    links = _verified(docs, pairs.filter(_near("a_", "b_")).select("a", "b").distinct())
    copies = nodes.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    links = cut(links.unionByName(copies))
    label = cut(components(links, "a", "b"))

    # what is left: members of one block in different components
    rows = rows.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "doc_id"))
    mixed = rows.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("members"))
    rows = cut(rows.join(mixed.filter("c0 < c1").select("key", "members"), "key").withColumn("grp", grp.cast("int")))
    spare = maybe_in(known, "doc_id", rows.select("doc_id").distinct()).mapInArrow(_spares, "doc_id long, grp int, spare int")
    hot = rows.groupBy("doc_id", "grp").agg(F.count("*").alias("all"), F.sum((F.col("members") > HOT).cast("int")).alias("hot"))
    may = hot.join(spare.groupBy("doc_id", "grp").agg(F.min("spare").alias("spare")), ["doc_id", "grp"])
    # a similar document shares more blocks than may be left out: who has no more can't have one
    may = may.filter("all > spare").select("doc_id", "grp", (F.col("hot") > F.col("spare")).alias("many"), F.greatest(F.col("spare") - F.col("hot"), F.lit(0)).alias("least"))
    rows = rows.join(may, ["doc_id", "grp"]).filter(f"members <= {HOT} or many").select("key", "grp", "doc_id", "component", "least")
    brief = [F.expr(" ^ ".join(_SKETCH[i::BRIEF])).alias(h) for i, h in enumerate(_BRIEF)]
    rows = cut(rows.distinct().join(shape.select("doc_id", "n", *brief), "doc_id"))
    one = rows.withColumnsRenamed({c: f"a_{c}" for c in rows.columns})
    two = rows.withColumnsRenamed({c: f"b_{c}" for c in rows.columns})
    meet = (F.col("a_key") == F.col("b_key")) & F.expr("a_component < b_component")
    rest = one.join(two, meet & _near("a_", "b_", _BRIEF))
    rest = rest.groupBy(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b"), "a_grp").agg(
        F.count("*").alias("blocks"), F.greatest(F.max("a_least"), F.max("b_least")).alias("least"))
    rest = rest.filter("blocks > least").select("a", "b").distinct()
    more = _verified(docs, shaped(shaped(rest, "a", "a_"), "b", "b_").filter(_near("a_", "b_")).select("a", "b").distinct())
    final = cut(components(links.unionByName(more), "a", "b"))
    out = digest.select("doc_id", F.col("n").alias("n_shingles")).join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


#: The same by brute force: common shingles by a join on them, components by reachability.
SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w
), x AS (SELECT doc_id, len(s) AS n, unnest(s) AS m FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.m = b.m AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {SIMILAR} * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS n, a AS m FROM links UNION SELECT r.n, l.b FROM reach r JOIN links l ON r.m = l.a
), component AS (SELECT n, min(m) AS c FROM reach GROUP BY n)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
FROM s LEFT JOIN component c ON c.n = s.doc_id
"""
