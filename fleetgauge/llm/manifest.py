"""Merkle manifest of a dataset: a postorder append log written by aligned builders, and its proofs.

A document's leaf is the hash of its fields. Leaves of a source are numbered by doc_id and dealt to builders of
CHUNK consecutive ones, FAN^TIER leaves, so each builder's trees are whole trees of the source's tree but
at its end. A builder reads its leaves in order and appends every node to its log when the node is complete, children
before parents; it holds one open run per level. The roots of builders are the leaves of the next tier's
builders, until one is left: the source's subroot. The subroots, in order of their sources, are the
leaves of one more such tree, whose root stands for the dataset.

No index is kept, since a node's place in the log is known in closed form. Before leaf a come a // FAN^g nodes of each
level g, and a subtree over c leaves has ceil(c / FAN^g) of them; so the node `index` of `level` is the last of its
subtree's nodes (position()). A proof takes the siblings of each level from these places and goes on in the
builder above. Leaves of one builder share all siblings above it, so these are read once a builder.

Numbering: leaves are cut thin, dealt by range of (source, doc_id, leaf, row) and counted per range and source,
so a source with a third of all rows, or equal rows in any number, are spread over tasks; running sums go over ranges, not
rows. Builders have at most CHUNK rows. The driver sees the root only.

Null fields are hashed as '-', null sources are a source of their own (the first), null doc_ids come first
in it. Rows that share a doc_id are leaves of their own, ordered by leaf; equal rows have equal leaves,
and a proof each. An empty table has no root and gives no rows. Long texts are hashed by the JVM where they
lie. Columns other than the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, cut

#: Children of a node; levels of a builder; leaves of a builder.
FAN, TIER = 16, 3
CHUNK = FAN**TIER
#: Bytes of a digest in the log: lowercase hex text.
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def height(n: int) -> int:
    """Levels above n leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def tree_size(leaves: int, top: int) -> int:
    """Nodes over consecutive leaves from an aligned one on, up to level `top`."""
    return sum(-(-leaves // FAN**g) for g in range(top + 1))


def position(level: int, index: int, leaves: int, top: int = TIER) -> int:
    """Place in the log of the index-th node of a level, in a log over so many leaves."""
    first = index * FAN**level
    before = sum(first // FAN**g for g in range(top + 1))
    return before + tree_size(min(FAN**level, leaves - first), level) - 1


class Builder:
    """Appends nodes in the order they are complete; holds at most FAN of each level."""

    def __init__(self, top: int):
        self.top, self.log, self.open = top, bytearray(), [[] for _ in range(top + 1)]

    def add(self, node: bytes, level: int = 0) -> None:
        self.log += node
        if level < self.top:
            run = self.open[level]
            run.append(node)
            if len(run) == FAN:
                self._finish(level)

    def _finish(self, level: int) -> None:
        node = digest(b"".join(self.open[level]))
        self.open[level] = []
        self.add(node, level + 1)

    def close(self) -> bytes:
        for level in range(self.top):
            if self.open[level]:
                self._finish(level)
        return bytes(self.log)


def _top(n: int) -> int:
    return TIER if n > CHUNK else height(n)


class Segment:
    """A builder's part of the log, read by closed-form places."""

    def __init__(self, log: bytes, n: int, builder: int):
        self.log, self.top, self.leaves = log, _top(n), min(n - builder * CHUNK, CHUNK)
        self.run = lru_cache(maxsize=4 * TIER)(self._run)

    def _run(self, level: int, first: int) -> list[bytes]:
        last = min(first + FAN, -(-self.leaves // FAN**level))
        places = (position(level, i, self.leaves, self.top) * HEX for i in range(first, last))
        return [self.log[p : p + HEX] for p in places]

    def path(self, leaf: int) -> tuple[list[bytes], list[bytes]]:
        """The siblings to the left and to the right, level by level up to the builder's root."""
        left, right = [], []
        for level in range(self.top):
            at = leaf % FAN
            run = self.run(level, leaf - at)
            left.append(b"".join(run[:at]))
            right.append(b"".join(run[at + 1 :]))
            leaf //= FAN
        return left, right


def fold(node: bytes, left: list[bytes], right: list[bytes]) -> bytes:
    """The root that a node and the siblings of its levels give."""
    for a, b in zip(left, right, strict=True):
        node = digest(a + node + b)
    return node


def leaf_of(text: Column | None = None) -> Column:
    """Hash of a document's fields, of another text where one is given."""
    fields = [text if name == "text" and text is not None else F.col(name) for name in FIELDS]
    parts = [
        F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
        for c in (f.cast("string") for f in fields)
    ]
    return F.sha2(F.concat(*parts), 256)


def lowered_fifth() -> Column:
    """A leaf as tampering leaves it: A-Z lower-cased where 5 divides the crc32 of the decimal doc_id; else null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf_of(F.translate(F.col("text").cast("string"), _UPPER, _LOWER)))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their number `idx` inside `tree`, by order, and `n`, the tree's rows."""
    keys = ["tree", *order, "__row"]
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranges = cut(ranges.drop("__row").withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    parts = ranges.groupBy("tree", "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__from"))
    of_tree = W.partitionBy("tree")
    earlier = of_tree.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    parts = parts.select(
        F.col("tree").alias("__tree"), F.col("__range").alias("__part"),
        (before - F.col("__from")).alias("__shift"), F.sum("__n").over(of_tree).alias("n"),
    )
    same = ranges["tree"].eqNullSafe(parts["__tree"]) & (ranges["__range"] == parts["__part"])
    found = ranges.join(parts, same).withColumn("idx", F.col("__at") + F.col("__shift"))
    return found.drop("__range", "__at", "__tree", "__part", "__shift")


_AT = ["tree", "builder"]


def _placed(nodes: DataFrame) -> DataFrame:
    spot = {"builder": F.expr(f"idx div {CHUNK}"), "rank": (F.col("idx") % CHUNK).cast("int")}
    return nodes.withColumns(spot).drop("idx")


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments from (tree, builder, rank, n, node) in this order."""
    at, held = None, None
    for batch in batches:
        columns = (column(batch, c).to_pylist() for c in ("tree", "builder", "n", "node"))
        for tree, builder, n, node in zip(*columns, strict=True):
            if held is None or at != (tree, builder, n):
                if held is not None:
                    yield _segment(at, held)
                at, held = (tree, builder, n), Builder(_top(n))
            held.add(node.encode())
    if held is not None:
        yield _segment(at, held)


def _segment(at: tuple, held: Builder) -> pa.RecordBatch:
    tree, builder, n = at
    values = [[tree], [builder], [n], [builder * tree_size(CHUNK, TIER)], [held.close()]]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["tree", "builder", "n", "first", "nodes"])


def append_logs(nodes: DataFrame) -> list[DataFrame]:
    """Logs of all tiers over (tree, idx, n, node): (tree, builder, n, first, nodes), one row a builder.

    n: leaves of the tree in this tier; first: place of the builder's first node in the tier's log.
    """
    logs = []
    while True:
        placed = _placed(nodes.select("tree", "idx", "n", "node"))
        dealt = placed.repartition(*_AT).sortWithinPartitions(*_AT, "rank")
        logs.append(cut(dealt.mapInArrow(_build, "tree string, builder long, n long, first long, nodes binary")))
        nodes = _roots(logs[-1].filter(F.col("n") > CHUNK))
        if nodes.isEmpty():
            return logs


def _roots(log: DataFrame) -> DataFrame:
    """Builders' roots, each the last node of its segment, as leaves of the next tier."""
    last = F.expr(f"substring(nodes, -{HEX}, {HEX})").cast("string")
    return log.select("tree", F.col("builder").alias("idx"), F.expr(f"(n + {CHUNK - 1}) div {CHUNK}").alias("n"), last.alias("node"))


def subroots(logs: list[DataFrame]) -> DataFrame:
    """(tree, node): the last node left of each tree."""
    return total_rows([_roots(log.filter(F.col("n") <= CHUNK)).select("tree", "node") for log in logs])


_PATH = "left array<string>, right array<string>"


def _streams(rows: DataFrame, segments: DataFrame, keep: list[str]) -> DataFrame:
    """Each builder's segment, then its rows by rank; rows have nulls for what only segments have and the other way."""
    none = lambda names, of: {c: F.lit(None).cast(of.schema[c].dataType) for c in names}
    own = ["nodes", "left", "right", "subroot"]
    rows = rows.withColumns(none(own, segments)).select(*_AT, "rank", "n", *keep, *own)
    heads = segments.withColumns({"rank": F.lit(-1), **none(keep, rows)}).select(*_AT, "rank", "n", *keep, *own)
    return heads.unionByName(rows).repartition(*_AT).sortWithinPartitions(*_AT, "rank")


def _walk(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[tuple]:
    """For each row: its kept values, both sides of its whole path, the subroot."""
    segment = above = subroot = None
    for batch in batches:
        columns = (column(batch, c).to_pylist() for c in ("tree", "builder", "rank", "n", "nodes", "left", "right", "subroot", *keep))
        for tree, builder, rank, n, nodes, left, right, root, *values in zip(*columns, strict=True):
            if rank < 0:
                segment, subroot = Segment(nodes, n, builder), root
                above = [s.encode() for s in left], [s.encode() for s in right]
                continue
            left, right = segment.path(rank)
            yield tree, builder * CHUNK + rank, values, left + above[0], right + above[1], subroot


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tree, idx, _, left, right, subroot in _walk(batches, []):
        sides = [[[s.decode() for s in side]] for side in (left, right)]
        arrays = [pa.array([tree], pa.string()), pa.array([idx], pa.int64()), *(pa.array(s, pa.list_(pa.string())) for s in sides)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([subroot], pa.string())], ["tree", "idx", "left", "right", "subroot"])


def _with_paths(log: DataFrame, above: DataFrame | None, top: DataFrame | str | None) -> DataFrame:
    """Segments of a tier with the path of their root: the tree's own at its last tier, else that of the next tier's leaf."""
    last = log.filter(F.col("n") <= CHUNK)
    if isinstance(top, DataFrame):
        top = top.select(F.col("tree").alias("__tree"), "left", "right", "subroot")
        found = last.join(top, last["tree"].eqNullSafe(top["__tree"])).drop("__tree")
    else:  # a single tree, with nothing above its root
        none = F.expr("cast(array() as array<string>)")
        found = last.withColumns({"left": none, "right": none, "subroot": F.lit(top).cast("string")})
    if above is not None:
        rest = log.filter(F.col("n") > CHUNK)
        above = above.select(F.col("tree").alias("__tree"), F.col("idx").alias("__idx"), "left", "right", "subroot")
        found = found.unionByName(
            rest.join(above, rest["tree"].eqNullSafe(above["__tree"]) & (rest["builder"] == above["__idx"])).drop("__tree", "__idx")
        )
    return found


def read_paths(logs: list[DataFrame], top: DataFrame | str | None) -> DataFrame:
    """Segments of the lowest tier with the siblings above their roots.

    top: (tree, left, right, subroot) of what is above the trees, or the root of a single tree.
    """
    above = None
    for tier in range(len(logs) - 1, 0, -1):
        segments = _with_paths(logs[tier], above, top)
        # The leaves of this tier are the builders below it.
        leaves = _placed(_roots(logs[tier - 1].filter(F.col("n") > CHUNK)))
        above = cut(_streams(leaves, segments, []).mapInArrow(_paths, f"tree string, idx long, {_PATH}, subroot string"))
    return _with_paths(logs[0], above, top)


@dataclass
class Manifest:
    """leaves: (doc_id, tree, idx, n, leaf, tampered); logs by tier; top: each source's way to the root."""

    leaves: DataFrame
    logs: list[DataFrame]
    source_logs: list[DataFrame]
    top: DataFrame
    root: str | None

    def log(self) -> DataFrame:
        """The whole log: (kind, tier, tree, builder, n, first, nodes)."""
        return total_rows([
            log.select(F.lit(kind).alias("kind"), F.lit(tier).alias("tier"), "tree", "builder", "n", "first", "nodes")
            for kind, logs in (("source", self.logs), ("dataset", self.source_logs)) for tier, log in enumerate(logs)
        ])

    def proofs(self) -> DataFrame:
        """A row a leaf: its subroot, the root, the digest of its proof, the root its (tampered) leaf folds to."""
        root = self.root

        def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            held: list[tuple] = []

            def flush() -> pa.RecordBatch:
                arrays = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
                held.clear()
                return pa.RecordBatch.from_arrays(arrays, names)

            for _, _, (doc_id, leaf, tampered), left, right, subroot in _walk(batches, ["doc_id", "leaf", "tampered"]):
                proof = digest(b"".join(a + b for a, b in zip(left, right, strict=True))).decode()
                folded = fold((tampered or leaf).encode(), left, right).decode()
                held.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
                if len(held) == CHUNK:
                    yield flush()
            if held:
                yield flush()

        rows = _streams(_placed(self.leaves), read_paths(self.logs, self.top), ["doc_id", "leaf", "tampered"])
        return rows.mapInArrow(
            prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )


def total_rows(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build_manifest(documents: DataFrame) -> Manifest:
    """Number the leaves, write all logs, find each source's way to the root."""
    leaves = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("tree"),
        leaf_of().alias("leaf"), lowered_fifth().alias("tampered"),
    )
    leaves = numbered(leaves, ["doc_id", "leaf"])
    logs = append_logs(leaves.withColumn("node", F.col("leaf")))
    # The tree over sources: one tree without a name, its leaves in order of the sources' names.
    sources = subroots(logs).select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("source"), "node")
    sources = numbered(sources, ["source"])
    source_logs = append_logs(sources)
    last = subroots(source_logs).first()
    root = None if last is None else last.node
    rows = _streams(_placed(sources), read_paths(source_logs, root), ["source", "node"])

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (source, node), left, right, _ in _walk(batches, ["source", "node"]):
            sides = [pa.array([[s.decode() for s in side]], pa.list_(pa.string())) for side in (left, right)]
            arrays = [pa.array([source], pa.string()), *sides, pa.array([node], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["tree", "left", "right", "subroot"])

    top = cut(rows.mapInArrow(ways, f"tree string, {_PATH}, subroot string"))
    return Manifest(leaves, logs, source_logs, top, root)


def prove_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each document."""
    return build_manifest(documents).proofs()


def _sql_field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE concat(strlen({name}::VARCHAR), ':', {name}::VARCHAR) END"


_SQL_LEAF = ", ".join(map(_sql_field, FIELDS))
#: The same rows in DuckDB's SQL: levels and ways to the root by recursion.
SQL = f"""
WITH RECURSIVE crc AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))) AS rest
  FROM documents
), changed AS (
  SELECT *, CASE WHEN xor(rest, 4294967295::BIGINT) % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END AS other
  FROM crc
), hashed AS (
  SELECT doc_id, source, sha256(concat({_SQL_LEAF})) AS leaf,
    sha256(concat({_SQL_LEAF.replace("text", "other")})) AS tampered
  FROM changed
), leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM hashed
), nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level, idx, d, count(*) OVER (PARTITION BY tree) FROM (
    SELECT tree, level + 1 AS level, idx // 16 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16)
), tops AS (
  SELECT 0 AS tree, 0 AS level, tree - 1 AS idx, d, count(*) OVER () AS n FROM nodes WHERE n = 1
  UNION ALL
  SELECT tree, level, idx, d, count(*) OVER () FROM (
    SELECT tree, level + 1 AS level, idx // 16 AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM tops WHERE n > 1 GROUP BY tree, level, idx // 16)
), runs AS (
  SELECT tree, level, idx // 16 AS run, list(d ORDER BY idx) AS members
  FROM (SELECT * FROM nodes UNION ALL SELECT * FROM tops) WHERE n > 1 GROUP BY tree, level, idx // 16
), steps AS (
  SELECT tree, idx AS leaf_idx, tree AS at, 0 AS level, idx, '' AS proof, tampered AS folded, false AS done FROM leaves
  UNION ALL
  SELECT s.tree, leaf_idx,
    CASE WHEN r.run IS NULL THEN 0 ELSE s.at END, CASE WHEN r.run IS NULL THEN 0 ELSE s.level + 1 END,
    CASE WHEN r.run IS NULL THEN s.tree - 1 ELSE s.idx // 16 END,
    CASE WHEN r.run IS NULL THEN proof ELSE concat(proof, array_to_string(members[1:s.idx % 16], ''), array_to_string(members[s.idx % 16 + 2:16], '')) END,
    CASE WHEN r.run IS NULL THEN folded ELSE sha256(concat(array_to_string(members[1:s.idx % 16], ''), folded, array_to_string(members[s.idx % 16 + 2:16], ''))) END,
    r.run IS NULL AND s.at = 0
  FROM steps s LEFT JOIN runs r ON r.tree = s.at AND r.level = s.level AND r.run = s.idx // 16
  WHERE NOT done
)
SELECT l.doc_id, l.leaf, sub.d AS subroot, top.d AS root, sha256(s.proof) AS proof_sha256, s.folded AS folded_root, s.folded = top.d AS verified
FROM leaves l JOIN steps s ON s.tree = l.tree AND s.leaf_idx = l.idx AND s.done
JOIN nodes sub ON sub.tree = l.tree AND sub.n = 1 CROSS JOIN (SELECT d FROM tops WHERE n = 1) top
"""
