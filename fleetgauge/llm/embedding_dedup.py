"""Near-duplicate vectors by sorted projection passes.

Each pass has 64 random directions of its own; a vector's hash has a bit for each, the side it lies on. All vectors
that share a pass's prefix (a run) are compared in double precision, however many they are, and pairs with a cosine of
SIMILAR or more join their groups. A pair at the threshold shares b bits with chance (1 - angle / pi) ^ b whatever lies
around it, so the number of passes follows from b alone and misses it with a chance of MISSED at most. b is a constant,
so whether a pair is found is told by its two vectors: a table of any size and density finds the same pairs.

The first SORTED passes are sorted by hash before: similar vectors, which share long prefixes, come close; each is compared
with those of its run among the WINDOW vectors before it. That joins groups of near copies at little cost and finds nothing
that the runs would not; they then leave out what is in one group already. Long runs are dealt over tasks in blocks.

Equal vectors are one node with a weight, so a group of copies is one row. Inside a group, links are then
counted exactly, whatever the windows met. All of a group within half the threshold angle of the group's
anchor link with one another by the triangle inequality, so they are only counted; the others are
compared block by block with the whole group, and only counts leave a task.

Vectors that are null, zero, or hold null or non-finite components link with nothing and keep their
row, as do rows with null ids; vectors of different dimensions do not meet. Rows that repeat an id are
vectors of their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, components, cut
from fleetgauge.llm.topk import finite

#: Least cosine of a link.
SIMILAR = 0.95
#: Vectors before each that it is compared with, bits of a hash, chance of missing a pair at the threshold.
WINDOW, BITS, MISSED = 64, 64, 0.01
#: Sorted passes, vectors of the table that runs are made for, and comparisons that a vector's row in a pass costs as much as.
SORTED, TABLE, ROW = 4, 1 << 26, 2000
#: Rows of a block inside a group, and of a task of small groups.
BLOCK = 2048
SEED = 4
#: Slack of angles, in radians: a member counted without a comparison is this much inside.
SLACK = 1e-6


def passes(bits: int) -> int:
    """Passes over runs of this many common bits, which a pair at the threshold shares with chance p in each."""
    p = (1 - math.acos(SIMILAR) / math.pi) ** bits
    return math.ceil(math.log(MISSED) / math.log(1 - p)) if p < 1 else 1


def _vectors(values: pa.Array) -> np.ndarray:
    """Vectors of one dimension as unit rows in double precision."""
    flat = np.asarray(values.flatten(), dtype=np.float64)
    m = flat.reshape(len(values), -1)
    m = m / np.maximum(np.abs(m).max(axis=1, initial=0.0), 1e-300)[:, None]
    return m / np.linalg.norm(m, axis=1)[:, None]


def _hash(unit: np.ndarray, turn: int) -> np.ndarray:
    """A pass's hashes."""
    ways = np.random.default_rng([SEED, turn, unit.shape[1]]).normal(size=(unit.shape[1], BITS))
    return np.packbits(unit @ ways >= 0, axis=1).view(">u8").ravel().astype(np.uint64)


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of one dimension, and their unit vectors."""
    for batch in batches:
        dims = np.asarray(column(batch, "dim"))
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            for lo in range(0, part.num_rows, 4096):
                rows = part.slice(lo, 4096)
                yield rows, _vectors(column(rows, "v"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each sorted pass: (dim, pass, hash, node, v)."""
    for rows, unit in _by_dim(batches):
        for k in range(SORTED):
            order = (_hash(unit, k) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(rows, "dim"), pa.array(np.full(len(order), k, np.int32)), pa.array(order), column(rows, "node"), column(rows, "v")],
                ["dim", "pass", "hash", "node", "v"])


def _prefix(unit: np.ndarray, turn: int, bits: int) -> np.ndarray:
    """The first bits of a pass's hashes."""
    return (_hash(unit, turn) >> np.uint64(BITS - bits)).view(np.int64) if bits else np.zeros(len(unit), np.int64)


def _prefixes(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each pass over runs: (dim, pass, prefix, node, component)."""
        for rows, unit in _by_dim(batches):
            for k in range(passes(bits)):
                yield pa.RecordBatch.from_arrays(
                    [column(rows, "dim"), pa.array(np.full(rows.num_rows, k, np.int32)), pa.array(_prefix(unit, k, bits)), column(rows, "node"), column(rows, "component")],
                    ["dim", "pass", "prefix", "node", "component"])

    return run


def _prefix_bits(vectors: int, row: int) -> int:
    """Bits at which a table of this many scattered vectors costs least: rows of all passes, pairs in runs."""
    return min(range(BITS), key=lambda b: passes(b) * (row + vectors / 2 ** (b + 1)))


class _Groups:
    """Groups of the nodes a task has seen, so that only joining pairs leave it."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(y, y)
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _windows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs (a, b) of one run that link and join two groups, from rows in the order of (dim, pass, hash)."""
        groups = _Groups()
        tail: tuple[int, int, np.ndarray, np.ndarray, np.ndarray] | None = None
        for batch in batches:
            dims, turns = np.asarray(column(batch, "dim")), np.asarray(column(batch, "pass"))
            prefixes = np.asarray(column(batch, "hash")) >> (BITS - bits) if bits else np.zeros(len(dims), np.int64)
            edges = np.flatnonzero((np.diff(dims) != 0) | (np.diff(turns) != 0)) + 1
            pairs: list[tuple[int, int]] = []
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if lo == hi:
                    continue
                own = (int(dims[lo]), int(turns[lo]))
                nodes, unit, prefix = np.asarray(column(batch, "node"))[lo:hi], _vectors(column(batch, "v").slice(lo, hi - lo)), prefixes[lo:hi]
                begin = 0
                if tail is not None and tail[:2] == own:
                    nodes, unit, prefix = (np.concatenate(x) for x in zip(tail[2:], (nodes, unit, prefix), strict=True))
                    begin = len(tail[2])
                for at in range(begin, len(nodes), 256):
                    end, back = min(at + 256, len(nodes)), max(0, at - WINDOW)
                    near = unit[at:end] @ unit[back:end].T >= SIMILAR
                    i, j = np.nonzero(near)
                    i, j = i + at, j + back
                    keep = (j < i) & (i - j <= WINDOW) & (prefix[i] == prefix[j])
                    pairs += [p for p in zip(nodes[i[keep]].tolist(), nodes[j[keep]].tolist(), strict=True) if groups.join(*p)]
                tail = (*own, nodes[-WINDOW:], unit[-WINDOW:], prefix[-WINDOW:])
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _across(nodes: np.ndarray, unit: np.ndarray, side: np.ndarray, groups: _Groups) -> list[tuple[int, int]]:
    """Pairs of groups that a link joins, from all pairs of rows of different groups (and sides)."""
    out: list[tuple[int, int]] = []

    def meet(rows: np.ndarray, others: np.ndarray) -> None:
        for lo in range(0, len(rows), 512):
            i, j = np.nonzero(unit[rows[lo : lo + 512]] @ unit[others].T >= SIMILAR)
            found = np.unique(np.stack([nodes[rows[lo + i]], nodes[others[j]]]), axis=1)
            out.extend((a, b) for a, b in found.T.tolist() if a != b and groups.join(a, b))

    if (side != 2).any():
        meet(np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        return out
    order = np.argsort(nodes, kind="stable")
    edges = [*np.flatnonzero(np.diff(nodes[order], prepend=-1)).tolist(), len(order)]
    lo = 0
    for k, hi in enumerate(edges[1:], 1):  # a large group only meets those behind it, small ones in batches also each other
        if hi - lo >= 256 or hi == len(order):
            alone = edges[k - 1] == lo
            meet(order[lo:hi], order[hi if alone else lo :])
            lo = hi
    return out


def _met(table: pa.Table) -> pa.Table:
    """Pairs (a, b) of groups that a link joins, from the runs or the two blocks of a task."""
    groups, pairs = _Groups(), []
    table = table.sort_by([("dim", "ascending"), ("pass", "ascending"), ("prefix", "ascending")]).combine_chunks()
    keys = np.stack([np.asarray(table.column(c)).astype(np.int64) for c in ("dim", "pass", "prefix")])
    edges = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), table.num_rows]
    for lo, hi in zip(edges, edges[1:], strict=False):
        if hi - lo > 1:
            rows = table.slice(lo, hi - lo)
            unit = _vectors(rows.column("v").combine_chunks())
            pairs += _across(np.asarray(rows.column("component")), unit, np.asarray(rows.column("side")), groups)
    return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})


def _run_pairs(single: DataFrame, groups: DataFrame, bits: int) -> DataFrame:
    """(a, b): groups that a link joins, of all vectors with a common prefix, from (node, dim, v) and (node, component)."""
    rows = single.select("node", "dim", "v").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = cut(rows)
    run = ["dim", "pass", "prefix"]
    keys = cut(rows.select("dim", "node", "component", "v").mapInArrow(_prefixes(bits), "dim int, pass int, prefix long, node long, component long"))
    parts = keys.groupBy(*run, "component").agg(F.count("*").alias("size"))
    sizes = cut(parts.groupBy(*run).agg(F.sum("size").alias("n"), F.count("*").alias("parts")).filter("parts > 1"))
    total = sizes.filter(f"n <= {BLOCK}").agg(F.sum("n")).first()[0] or 0
    small = keys.join(sizes.filter(f"n <= {BLOCK}"), run).withColumns({"owner": F.lit(-1), "x": F.lit(-1), "y": F.lit(-1), "side": F.lit(2)})
    small = small.withColumn("task", F.pmod(F.xxhash64(*run), F.lit(total // (4 * BLOCK) + 1)))
    # a long run: groups of more than a block have blocks of their own, which do not meet each other
    large = keys.join(parts.join(sizes.filter(f"n > {BLOCK}"), run), [*run, "component"])
    own = F.col("size") > BLOCK
    large = large.withColumn("owner", F.when(own, F.col("component")).otherwise(-1))
    large = large.withColumn("at", F.when(own, F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK))).otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / BLOCK))))
    large = cut(large.withColumn("block", F.xxhash64("owner", "at")).select(*run, "node", "component", "owner", "block"))
    blocks = large.select(*run, "owner", "block").distinct()
    others = blocks.select(*run, F.col("owner").alias("owner2"), F.col("block").alias("block2"))
    pairs = blocks.join(others, run).filter("block < block2 and (owner <> owner2 or owner = -1) or block = block2 and owner = -1")
    pairs = cut(pairs.select(*run, F.col("block").alias("x"), F.col("block2").alias("y")))
    first = pairs.select(*run, F.col("x").alias("block"), "x", "y", F.when(F.col("x") == F.col("y"), 2).otherwise(0).alias("side"))
    second = pairs.filter("x <> y").select(*run, F.col("y").alias("block"), "x", "y", F.lit(1).alias("side"))
    large = large.join(first.unionByName(second), [*run, "block"]).withColumn("task", F.xxhash64(*run))
    fields = ["task", "x", "y", *run, "node", "component", "side"]
    met = small.select(*fields).unionByName(large.select(*fields)).join(rows.select("node", "v"), "node")
    return met.groupBy("task", "x", "y").applyInArrow(_met, "a long, b long")


def _unit(rows: pd.DataFrame) -> np.ndarray:
    return _vectors(pa.array(rows["v"].tolist(), pa.list_(pa.float64())))


def _counted(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Weight of the members that each node of the task links with; pairs of core members are not met here."""
    out = []
    for _, group in rows.groupby("component"):
        unit, weight = _unit(group), group["weight"].to_numpy()
        core, side, node = group["core"].to_numpy(), group["side"].to_numpy(), group["node"].to_numpy()
        for lo in range(0, len(node), 512):
            near = unit[lo : lo + 512] @ unit.T >= SIMILAR
            near &= ~(core[lo : lo + 512, None] & core[None, :])
            if (side != 2).any():  # two blocks: only pairs across
                near &= side[lo : lo + 512, None] != side[None, :]
            near[np.arange(len(near)), np.arange(lo, lo + len(near))] = False
            out.append(pd.DataFrame({"node": node[lo : lo + 512], "links": near @ weight}))
    return pd.concat(out) if out else pd.DataFrame({"node": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64")})


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each member lies within half the threshold angle of its group's anchor."""
    half = math.acos(SIMILAR) / 2 - SLACK
    for batch in batches:
        dims = np.asarray(column(batch, "dim"))
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            cosine = np.einsum("ij,ij->i", _vectors(column(part, "v")), _vectors(column(part, "anchor")))
            core = pa.array(np.arccos(np.clip(cosine, -1, 1)) <= half)
            yield pa.RecordBatch.from_arrays([*(column(part, c) for c in ("node", "component", "weight", "v")), core], ["node", "component", "weight", "v", "core"])


def _links(members: DataFrame) -> DataFrame:
    """(node, links): weight of the other members each links with, from (node, component, weight, dim, v)."""
    anchors = members.filter("node = component").select("component", F.col("v").alias("anchor"))
    rows = members.join(anchors, "component").mapInArrow(_angles, "node long, component long, weight long, v array<double>, core boolean")
    rows = cut(rows)
    sizes = rows.groupBy("component").agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("core_weight"),
        F.ceil(F.sum(F.col("core").cast("int")) / BLOCK).cast("int").alias("inner"), F.ceil(F.sum((~F.col("core")).cast("int")) / BLOCK).cast("int").alias("outer"))
    sizes = cut(sizes)
    rows = rows.join(sizes, "component")
    inside = rows.filter("core").select("node", (F.col("core_weight") - F.col("weight")).alias("links"))
    rows = rows.filter("outer > 0")  # a group of core members only is counted already
    total = rows.filter(f"n <= {BLOCK}").count()
    small = rows.filter(f"n <= {BLOCK}").withColumns({"x": F.lit(-1), "y": F.lit(-1), "side": F.lit(2)})
    small = small.withColumn("task", F.pmod(F.xxhash64("component"), F.lit(total // BLOCK + 1)))
    # a large group: its outer blocks meet each other and the inner ones; blocks 0 .. outer - 1 are the outer ones
    large = rows.filter(f"n > {BLOCK}").withColumn("task", F.col("component"))
    own = F.when(F.col("core"), F.col("outer") + F.pmod(F.xxhash64("node"), F.greatest("inner", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.col("outer")))
    large = large.withColumn("own", own.cast("int"))
    other = F.when(F.col("core"), F.expr("sequence(0, outer - 1)")).otherwise(F.expr("sequence(0, outer + inner - 1)"))
    large = large.withColumn("other", F.explode(other))
    side = F.when(F.col("own") == F.col("other"), 2).otherwise(F.when(F.col("own") < F.col("other"), 0).otherwise(1))
    large = large.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other"), "side": side})
    fields = ["task", "x", "y", "node", "component", "weight", "core", "side", "v"]
    met = small.select(*fields).unionByName(large.select(*fields)).groupBy("task", "x", "y").applyInPandas(_counted, "node long, links long")
    return met.unionByName(inside).groupBy("node").agg(F.sum("links").alias("links"))


def linked_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of embeddings(vec_id, embedding)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    some = F.col("vec_id").isNotNull() & finite(F.col("v")) & F.exists("v", lambda x: x != 0)
    rows = cut(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", F.when(some, F.col("v")).alias("v")))
    alike = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(SEED), F.reverse("v")).alias("h2"), F.size("v").alias("dim")]
    full = rows.filter("v is not null").select("rid", "vec_id", "v", *alike)
    same = full.groupBy("h1", "h2", "dim").agg(F.min("rid").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    nodes = cut(full.join(same, ["h1", "h2", "dim"]).select("rid", "vec_id", "v", "dim", "node", "weight", "least"))
    single = nodes.filter("rid = node")

    bits = _prefix_bits(TABLE, ROW)
    hashed = single.select("dim", "node", "v").mapInArrow(_hashed, "dim int, pass int, hash long, node long, v array<double>")
    order = ("dim", "pass", "hash", "node")
    pairs = hashed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_windows(bits), "a long, b long")
    near = cut(components(pairs, "a", "b"))
    more = _run_pairs(single, near, bits).unionByName(near.select(F.col("node").alias("a"), F.col("component").alias("b")))
    groups = cut(components(more, "a", "b"))
    members = cut(single.select("node", "weight", "dim", "v", "least").join(groups, "node"))
    links = _links(members.drop("least"))
    first = members.groupBy("component").agg(F.min("least").alias("first"))
    groups = groups.join(first, "component").join(links, "node", "left").select("node", "first", "links")
    found = nodes.select("rid", "node", "weight", "least").join(groups, "node", "left")
    n = (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    found = found.select("rid", n, F.coalesce("first", "least").alias("found_id"))
    out = rows.select("rid", "vec_id").join(found, "rid", "left")
    out = out.withColumns({"n_links": F.coalesce("n_links", F.lit(0)).cast("long"), "component_id": F.coalesce("found_id", "vec_id")})
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: The same by brute force; equal as long as the passes miss no group.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= {SIMILAR}
), reach AS (
  SELECT a AS n, a AS m FROM links UNION SELECT r.n, l.b FROM reach r JOIN links l ON r.m = l.a
), component AS (SELECT n, min(m) AS c FROM reach GROUP BY n),
counts AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(k.n_links, 0) AS BIGINT) AS n_links, coalesce(c.c, e.vec_id) AS component_id,
       coalesce(c.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN component c ON c.n = e.vec_id LEFT JOIN counts k ON k.a = e.vec_id
"""
