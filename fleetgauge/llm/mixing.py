"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source's target divided by its size is the copies each of its documents should have on average:
a whole part, which every document gets, and a fraction, its probability of one more. The pivotal
step takes two documents with fractional probabilities and moves words from one to the other, in a
random direction, until one probability is 0 or 1. The words expected of the two together do not
change, nor does either expectation. Repeated, one fractional document is left of a source, so the
source's words miss the target by that document's size at most.

The steps run as a reduction tree: documents are dealt by hash into leaves of about LEAF of one
source, each leaf is folded to one residual document, the residuals are dealt into leaves again.
A source with a third of all rows is many leaves; no task or driver sees a whole source.

Randomness is a hash of (doc_id, size), so reruns agree. Null text: size 0. Null source: a source of
its own, last in the order. Documents of size 0 take nothing. Rows that repeat a doc_id are documents
of their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.llm.shared import cut

#: Source weights, in order, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and the most copies of a document.
SHARE, COPIES = 1.5, 2
#: Documents of a leaf of the tree.
LEAF = 256
#: Probabilities this close to 0 or 1 are whole.
WHOLE = 1e-9
SEED = 8


def words(text: Column) -> Column:
    """Number of runs without space and tab to CR; 0 for null."""
    inner = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    n = F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, r"[\x20\x09-\x0D]+")))
    return F.coalesce(n, F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size): weighted shares, capped at COPIES times.

    The shares are the level L with sum of min(cap, L * weight) = total: sort by cap / weight, and
    the sources below the level are full. Sizes are summed per source before anything is ordered.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), place.cast("int") + 1)
    by = by.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(COPIES))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    below, all_rows = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(all_rows) * SHARE
    rest = total - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    free = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", rest / free).withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(all_rows)["level"]
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return by.select("source", "source_size", target.alias("target"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fold(state: Column, x: Column) -> Column:
    """One pivotal step between the residual of the leaf so far and document x."""

    def moved(m: Column) -> Column:
        r = state["left"]
        up = x["luck"] * (m["a"] + m["b"]) < m["b"]
        full, empty = m["a"] == (1 - r["p"]) * r["size"], m["b"] == r["p"] * r["size"]
        r_new = F.when(up, F.when(full, F.lit(1.0)).otherwise(r["p"] + m["a"] / r["size"])).otherwise(
            F.when(empty, F.lit(0.0)).otherwise(r["p"] - m["b"] / r["size"]))
        x_new = F.when(up, F.when(full, x["p"] - m["a"] / x["size"]).otherwise(F.lit(0.0))).otherwise(
            F.when(empty, x["p"] + m["b"] / x["size"]).otherwise(F.lit(1.0)))
        return F.struct((F.when(up, full).otherwise(empty)).alias("settled"), r_new.alias("r"), x_new.alias("x"))

    def parted(n: Column) -> Column:
        r = state["left"].withField("p", n["r"])
        other = x.withField("p", n["x"])
        done, left = F.when(n["settled"], r).otherwise(other), F.when(n["settled"], other).otherwise(r)
        return F.struct(left.alias("left"), F.concat(state["done"], F.array(done)).alias("done"))

    r = state["left"]
    give = F.least((1 - r["p"]) * r["size"], x["p"] * x["size"])
    take = F.least(r["p"] * r["size"], (1 - x["p"]) * x["size"])
    step = _let(F.struct(give.alias("a"), take.alias("b")), lambda m: _let(moved(m), parted))
    return F.when(r["size"].isNull(), F.struct(x.alias("left"), state["done"].alias("done"))).otherwise(step)


def _round(rows: DataFrame, level: int) -> DataFrame:
    """Rows (source, row, size, p) after one level: all but one of each leaf have p 0 or 1."""
    count = rows.groupBy("source").agg(F.ceil(F.count("*") / LEAF).alias("leaves"))
    one = F.xxhash64(F.lit(SEED), F.lit(level), "doc_id", "size")
    dealt = rows.join(count.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("leaf", F.pmod(one, F.col("leaves")))
    luck = F.pmod(F.xxhash64(F.lit(SEED + 1), F.lit(level), "doc_id", "size"), F.lit(1 << 53)) / float(1 << 53)
    x = F.struct(one.alias("order"), "doc_id", "size", "p", "base", luck.alias("luck"))
    kind = "struct<order:bigint,doc_id:bigint,size:bigint,p:double,base:bigint,luck:double>"
    zero = F.struct(F.lit(None).cast(kind).alias("left"), F.array().cast(f"array<{kind}>").alias("done"))
    folded = dealt.groupBy("source", "leaf").agg(F.sort_array(F.collect_list(x)).alias("xs"))
    folded = folded.select("source", F.aggregate("xs", zero, _fold).alias("t"))
    out = folded.select("source", F.explode(F.concat("t.done", F.array("t.left"))).alias("x"))
    return out.select("source", "x.doc_id", "x.size", "x.p", "x.base")


def mix_plan(documents: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), a row for each document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words(F.col("text")).alias("size"))
    docs = cut(docs)
    aim = cut(targets(docs))
    same = F.col("source").eqNullSafe(F.col("s"))
    share = (F.col("target") / F.nullif("source_size", F.lit(0))).alias("share")
    rows = docs.join(aim.select(F.col("source").alias("s"), share), same).drop("s")
    rows = rows.withColumn("share", F.when(F.col("size") > 0, F.least("share", F.lit(float(COPIES)))).otherwise(0.0))
    rows = rows.withColumn("base", F.floor(F.col("share") + WHOLE)).withColumn("p", F.greatest(F.col("share") - F.col("base"), F.lit(0.0)))
    rows = rows.select("source", "doc_id", "size", "p", "base")
    open_ = F.col("p").between(WHOLE, 1 - WHOLE)
    settled, level = [rows.filter(~open_)], 0
    rows = rows.filter(open_)
    while True:
        most = rows.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        rows, level = cut(_round(rows, level)), level + 1
        settled.append(rows.filter(~open_))
        rows = rows.filter(open_)
    luck = F.pmod(F.xxhash64(F.lit(SEED + 2), "doc_id", "size"), F.lit(1 << 53)) / float(1 << 53)
    settled.append(rows.withColumn("p", (luck < F.col("p")).cast("double")))
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    out = out.join(aim.withColumnRenamed("source", "s"), same).drop("s")
    out = out.withColumn("copies", F.col("base") + F.round("p").cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
