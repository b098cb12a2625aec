import numpy as np

from fleetgauge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows):
    good = [(i, np.floor(64 * np.asarray(v, np.float32).astype(float))) for i, v, *_ in rows
            if i is not None and v is not None and None not in v and np.isfinite(np.asarray(v, float)).all()]
    out = []
    for a, (i, q) in enumerate(good):
        if i % 20 == 0:
            found = sorted((-int(q @ v), j) for b, (j, v) in enumerate(good) if a != b and len(v) == len(q))
            out += [(i, k, j, -s) for k, (s, j) in enumerate(found[:20], 1)]
    return sorted(out)


def run(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v, *_ in rows]
    return sorted(tuple(r) for r in topk.top_inner_products(spark.createDataFrame(rows, SCHEMA)).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 100)
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(8, 12))
    flat = centers[rng.integers(8, size=700)] + 0.2 * rng.normal(size=(700, 12))
    unit = flat / np.linalg.norm(flat, axis=1)[:, None]
    for m in (unit, flat * rng.lognormal(0, 1, 700)[:, None], np.round(unit, 1)):
        rows = list(enumerate(np.asarray(m, np.float32).tolist()))
        assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [9.0, 9.0]),
            (5, [0.0, 0.0]), (20, [-1.0, -1.0]), (40, [1.0]), (60, []), (6, [0.5, 0.25]), (80, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0])]) == []
