"""Exact top-k by inner product: vectors grouped by length, pruned by local cosine thresholds, verified.

Vectors are grouped into buckets of similar length, large buckets into chunks of about CHUNK. A
query's k-th best score among the longest vectors bounds its result from below. In a bucket whose longest
vector has length m, a result of query q needs a cosine of bound / (|q| * m): above 1, the
bucket is never sent to the query. Else, where the local threshold is high, a few of the query's
largest coordinates bound the same coordinates of a result (coordinate pruning); where it is low, only
the lengths do (length pruning). What remains is scored exactly, and the k best of each chunk are merged.

Queries come in blocks of about BLOCK, so a task holds one chunk and one block, however many there are.
Rows with null ids, null vectors, or null or non-finite components take no part; vectors of different
dimensions do not meet. A repeated id is a row of its own, so its twin is a candidate. Ties go to the smaller
id. Other columns are ignored. An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.shared import cut

#: Components are floor(SCALE * x); results of a query; every EVERY-th id is a query.
SCALE, TOP, EVERY = 64, 20, 20
#: Longest over shortest vector of a bucket; rows of a chunk, queries of a block, vectors of the first bound.
RATIO, CHUNK, BLOCK, FIRST = 1.05, 4096, 512, 512
#: Coordinates looked at, and the local threshold from which they prune more than they cost.
FOCUS, STEEP = 4, 0.25
#: Relative slack of bounds in floating point.
SLACK = 1e-9
#: Magnitude up to which double precision adds products exactly.
EXACT = 2.0**53


def finite(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, good)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def _scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond double's range in integers (modulo 2 ** 64, as the type long has it)."""
    top = (np.abs(rows).max(initial=0.0) * np.abs(query).max(initial=0.0)) * max(1, len(query))
    if top < EXACT:
        return (rows @ query).astype(np.int64)
    return (rows.astype(np.int64) * query.astype(np.int64)).sum(axis=1)


def _first_bounds(key: tuple, queries: pd.DataFrame, first: pd.DataFrame) -> pd.DataFrame:
    """The k-th best score of each query among the longest vectors; -infinity if there are fewer."""
    rows, ids = _matrix(first["v"]), first["rid"].to_numpy()
    bounds = []
    for rid, v in zip(queries["rid"], queries["v"], strict=True):
        score = _scores(rows, np.asarray(v, float))[ids != rid]
        bounds.append(float(np.partition(score, len(score) - TOP)[len(score) - TOP]) if len(score) >= TOP else -np.inf)
    return queries.assign(bound=np.array(bounds, float))[["rid", "vec_id", "dim", "norm", "v", "block", "bound"]]


def _best(key: tuple, queries: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
    """The k best rows of a chunk for each query of a block."""
    out = []
    if len(queries) and len(probes):
        probes = probes.sort_values("norm", ascending=False)
        rows, norms, ids, rids = _matrix(probes["v"]), probes["norm"].to_numpy(), probes["vec_id"].to_numpy(), probes["rid"].to_numpy()
        unit = rows / np.maximum(norms, 1e-300)[:, None]
        for q in queries.itertuples():
            v = np.asarray(q.v, float)
            reach = q.norm * norms[0]
            local = q.bound / reach if reach > 0 else -1.0
            if q.bound > 0 and local >= STEEP:
                t, u = min(1.0, local * (1 - SLACK)), v / q.norm
                near = np.ones(len(rows), bool)
                for f in np.argsort(-np.abs(u))[:FOCUS]:
                    # the extremes that a coordinate of a vector with a cosine of t or more can take
                    wide = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + 1e-7
                    low = t * u[f] - wide if u[f] >= -t else -2.0
                    high = t * u[f] + wide if u[f] <= t else 2.0
                    near &= (unit[:, f] >= low) & (unit[:, f] <= high)
                at = np.flatnonzero(near)
            elif q.bound > 0:
                at = np.arange(np.searchsorted(-norms, -(q.bound / q.norm) * (1 - SLACK), side="right"))
            else:
                at = np.arange(len(rows))
            score = _scores(rows[at], v)
            good = (rids[at] != q.rid) & (score >= q.bound)
            at, score = at[good], score[good]
            order = np.lexsort((ids[at], -score))[:TOP]
            out.append(pd.DataFrame({"rid": q.rid, "query_id": q.vec_id, "vec_id": ids[at[order]], "score": score[order]}))
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("rid", "query_id", "vec_id", "score")})


def top_inner_products(embeddings: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): the TOP best rows of each query."""
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    vectors = vectors.filter(F.col("vec_id").isNotNull() & finite(F.col("v")))
    vectors = vectors.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    vectors = vectors.select(F.monotonically_increasing_id().alias("rid"), "vec_id", F.size("v").alias("dim"), F.sqrt(square).alias("norm"), "v")
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / float(np.log(RATIO)))).otherwise(-(10**6)).cast("int")
    vectors = cut(vectors.withColumn("bucket", bucket))

    buckets = vectors.groupBy("dim", "bucket").agg(F.max("norm").alias("most"), F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    buckets = cut(buckets)
    asked = vectors.filter(F.col("vec_id") % EVERY == 0).drop("bucket")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    asked = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")).drop("blocks")
    longest = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("norm"), "rid"))
    first = vectors.select("rid", "dim", "norm").withColumn("place", longest).filter(F.col("place") <= FIRST)
    first = first.select("rid").join(vectors.select("rid", "dim", "v"), "rid")
    first = first.join(asked.select("dim", "block").distinct(), "dim")
    first = first.toDF(*first.columns)  # columns of its own, as the two sides of a cogroup need
    keys = ("dim", "block")
    bounded = asked.groupBy(*keys).cogroup(first.groupBy(*keys)).applyInPandas(
        _first_bounds, "rid long, vec_id long, dim int, norm double, v array<double>, block int, bound double")
    bounded = cut(bounded)

    reach = F.col("norm") * F.col("most") * (1 + SLACK) >= F.col("bound")
    sent = bounded.join(buckets, "dim").filter(reach | (F.col("bound") <= 0))
    sent = sent.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)"))).drop("most", "chunks")
    sent = cut(sent)
    held = vectors.join(buckets.drop("most"), ["dim", "bucket"])
    held = held.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.col("chunks")).cast("int")).drop("chunks")
    keys = ("dim", "bucket", "chunk", "block")
    held = held.join(sent.select(*keys).distinct(), list(keys[:3]))
    held = held.toDF(*held.columns)
    best = sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(_best, "rid long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= TOP).select("query_id", "rank", "vec_id", "score")


#: The same by brute force.
SQL = f"""
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
