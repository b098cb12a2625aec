import random
import re

import pyarrow as pa

from fleetgauge.llm import ngram_join
from fleetgauge.llm.ngram_join import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                x, y = sorted((root(a), root(rows[j][0])))
                parent[y] = x
    return sorted((d, len(s), root(d)) for (d, _), s in zip(rows, sets))


def corpus(seed, n=220):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 4, 5, 6, 9, 20, 60, 150]))) for _ in range(n // 3)]
    passage = " ".join(rng.choices(words, k=12))
    while len(texts) < n:
        parts = rng.choice(texts[: n // 3]).split()
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            parts[rng.randrange(len(parts))] = rng.choice(words)
        if rng.random() < 0.2:
            parts += passage.split()
        if rng.random() < 0.2:
            parts = parts[: max(1, int(len(parts) * 0.8))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts).upper() if rng.random() < 0.3 else " ".join(parts))
    rng.shuffle(texts)
    return list(enumerate(texts, start=5))


def run(spark, rows, schema="doc_id long, text string"):
    return sorted(tuple(r) for r in near_duplicates(spark.createDataFrame(rows, schema)).collect())


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert run(spark, rows) == brute(rows)


def test_large_group_of_variants_is_one_component(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(150):
        own = list(base)
        own[rng.randrange(120)] = f"x{d}"
        rows.append((d, " ".join(own)))
    rows += [(1000 + d, f"other {d} words here that nobody shares at all {d}") for d in range(40)]
    assert run(spark, rows) == brute(rows)


def test_null_empty_and_repeated(spark):
    rows = [(3, None, "x"), (1, "", "x"), (2, " \t\n", "x"), (7, "a b", None), (5, "A  b", "y"), (9, "b a", "y")]
    got = run(spark, rows, "doc_id long, text string, component string")
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (7, 1, 5), (9, 1, 9)]
    rows = [(4, "same words in this text"), (4, "same words in this text"), (None, "same words in this text")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == ["(4, 1, 4)", "(4, 1, 4)", "(None, 1, None)"]


def test_empty_table_and_long_text(spark):
    assert run(spark, []) == []
    long = " ".join(f"t{i}" for i in range(60_000))
    assert run(spark, [(1, long), (2, long + " end"), (3, "x" * 3_000_000)]) == [(1, 59996, 1), (2, 59997, 1), (3, 1, 3)]


def test_keys_of_blocks_are_narrow():
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 30, 400)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], ["doc_id", "text"])
    keys = [k for part in ngram_join._blocks(iter([batch])) for k in part.column(0).to_pylist()]
    assert keys and all(0 <= k < 1 << 52 for k in keys)
