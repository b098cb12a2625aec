import random

from fleetgauge.llm.mixing import mix_plan


def level_targets(sizes):
    """Shares by the rule as told: cap, reshare the excess by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        share = {s: 2 * sizes[s] if s in full else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in full and share[s] > 2 * sizes[s] + 1e-9}
        if not above:
            return share
        full |= above


SCHEMA = "doc_id long, text string, source string, copies string"


def test_targets_and_taken(spark):
    rng = random.Random(1)
    rows = []
    for d in range(2500):
        source = "big" if d % 3 == 0 else rng.choice(["a", "b", "é", "Z", None, "c9", "c10"])
        rows.append((d, "w " * rng.choice([0, 1, 3, 10, 50, 200]), source, "x"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = {r.doc_id: r for r in mix_plan(df).collect()}
    assert len(got) == 2500
    sizes = {}
    for d, t, s, _ in rows:
        assert got[d].size == len(t.split())
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = level_targets(sizes)
    for d, _, s, _ in rows:
        assert got[d].source_size == sizes[s] and abs(got[d].target - want[s]) < 1e-6 * (1 + want[s])
        assert 0 <= got[d].copies <= 2 and got[d].taken == got[d].copies * got[d].size
    for s in sizes:
        assert abs(sum(got[d].taken for d, _, x, _ in rows if x == s) - want[s]) <= 201
    again = {r.doc_id: r.taken for r in mix_plan(df.repartition(3)).collect()}
    assert again == {d: r.taken for d, r in got.items()}


def test_odd_rows(spark):
    rows = [(1, None, "a", None), (2, "", None, None), (3, " \n", "b", None), (4, "one", None, None), (4, "one", None, None), (None, "x y", "a", None)]
    got = mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and sum(r.size for r in got) == 4
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert mix_plan(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in mix_plan(spark.createDataFrame([(1, None, None, None)], SCHEMA)).collect()] == [0]


def test_long_text(spark):
    rows = [(1, "word " * 1_000_000, "a", None), (2, "b " * 10, "a", None)]
    assert sorted(r.size for r in mix_plan(spark.createDataFrame(rows, SCHEMA)).collect()) == [10, 1_000_000]
