import random
import re

import pyarrow as pa

from fleetgauge.llm.lines import dedup_lines
from fleetgauge.llm.shared import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(line):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(line)]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Rows of distinct ids, in any order."""
    earlier, out = [], {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        if not t:
            out[d] = t
            continue
        kept = []
        for line in t.split("\n"):
            s = shingles(line)
            common = [len(s & e) for e in earlier] if s else []
            if not any(100 * c >= 75 * (len(s) + len(e) - c) for c, e in zip(common, earlier)):
                kept.append(line)
            if s:
                earlier.append(s)
        out[d] = "\n".join(kept)
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    pool = [" ".join(rng.choices(words, k=rng.choice([1, 2, 4, 5, 8, 20, 45, 90]))) for _ in range(60)]
    rows = []
    for d in range(90):
        lines = []
        for _ in range(rng.randrange(7)):
            parts = (rng.choice(pool) if rng.random() < 0.7 else " ".join(rng.choices(words, k=30))).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                parts[rng.randrange(len(parts))] = rng.choice(words)
            lines.append(rng.choice([" ", "  ", "\t"]).join(parts) + rng.choice(["", "", "\r", " "]))
            if rng.random() < 0.1:
                lines.append("")
        rows.append((d, "\n".join(lines)))
    rng.shuffle(rows)
    return rows


def run(spark, rows, schema="doc_id long, text string"):
    return dedup_lines(spark.createDataFrame(rows, schema))


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert {r.doc_id: r.text for r in run(spark, rows).collect()} == brute(rows)


def test_group_of_variants(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(120):
        own = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            own[rng.randrange(60)] = f"x{d}"
        rows.append((d, " ".join(own) + f"\nunique line number {d} with its own words {d}"))
    assert {r.doc_id: r.text for r in run(spark, rows).collect()} == brute(rows)


def test_odd_rows(spark):
    rows = [(2, "a b\nc", None, "g"), (1, None, "m", "g"), (3, "", "m", "g"), (None, "c\n\n \nd", "m", "g"), (2, "a b\nc", "k", "g"), (4, "C \n A  B", "m", None)]
    got = run(spark, rows, "doc_id long, text string, mark string, gone string").collect()
    assert len(got) == 6 and {(r.mark, r.gone) for r in got if r.doc_id == 2} == {(None, "g"), ("k", "g")}
    assert [(r.text, r.n_removed) for r in got if r.doc_id is None] == [("c\n\n \nd", 0)]
    assert {r.doc_id: r.text for r in got}[1] is None and {r.doc_id: r.text for r in got}[4] == ""
    assert [r.text for r in got if r.doc_id == 2] == ["a b", "a b"]


def test_empty_and_long(spark):
    assert run(spark, []).collect() == []
    long = " ".join(f"t{i}" for i in range(50_000))
    many = "\n".join(f"line {i} of many lines" for i in range(20_000))
    got = {r.doc_id: r.text for r in run(spark, [(1, long + "\n" + many), (2, long + " z"), (3, many)]).collect()}
    assert got == {1: long + "\n" + many, 2: "", 3: ""}


def test_texts_reach_python_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    texts = spark.range(6000, numPartitions=1).selectExpr("repeat('word ', 400) as text")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    assert max(r.size for r in cut(texts.mapInArrow(sizes, "size long")).collect()) < 4 << 20
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
