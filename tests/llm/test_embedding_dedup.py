import numpy as np

from fleetgauge.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, n_links string"


def brute(rows):
    good = {k: np.asarray(v, np.float32).astype(float) for k, (i, v, *_) in enumerate(rows)
            if i is not None and v is not None and None not in v and np.isfinite(np.asarray(v, float)).all() and np.any(np.asarray(v, float))}
    keys = sorted(good)
    up = {k: k for k in keys}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = dict.fromkeys(keys, 0)
    for a in keys:
        for b in keys:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.95:
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    least = {}
    for k in keys:
        least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    out = []
    for k, (i, *_) in enumerate(rows):
        c = least[root(k)] if k in good else i
        out.append((i, links.get(k, 0), c, i == c))
    return sorted(out, key=str)


def run(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x") for i, v, *_ in rows]
    return sorted((tuple(r) for r in E.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


def cluster(rng, center, n, spread):
    m = center + spread * rng.normal(size=(n, len(center))) / np.sqrt(len(center))
    return (m / np.linalg.norm(m, axis=1)[:, None]).astype(np.float32).tolist()


def corpus(seed, alone=300, dim=24):
    rng = np.random.default_rng(seed)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rng.normal(size=dim))
    rows = [unit().astype(np.float32).tolist() for _ in range(alone)]
    for n, spread in ((2, 0.05), (2, 0.1), (2, 0.2), (3, 0.2), (30, 0.1), (180, 0.2), (150, 0.3), (90, 0.02)):
        rows += cluster(rng, unit(), n, spread)
    rows += rows[:20] + [rows[-1]] * 60
    order = rng.permutation(len(rows))
    return [(int(k), rows[j]) for k, j in enumerate(order)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 40)  # so that large groups are split
    monkeypatch.setattr(E, "WINDOW", 16)
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)


def test_recall_of_single_pairs(spark):
    rng = np.random.default_rng(2)
    rows, dim = [], 32
    for k in range(600):
        a = rng.normal(size=dim)
        a /= np.linalg.norm(a)
        b = rng.normal(size=dim)
        b -= (a @ b) * a
        cosine = rng.uniform(0.951, 0.999)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b)).tolist())]
    got, want = run(spark, rows), brute(rows)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.97 * there <= found <= there


def test_pairs_in_a_hot_topic(spark, monkeypatch):
    """Every other vector of a dense topic stands between the two of a pair in sorted order."""
    monkeypatch.setattr(E, "WINDOW", 4)
    monkeypatch.setattr(E, "BLOCK", 100)
    rng = np.random.default_rng(6)
    dim, n, cosine = 64, 1200, 0.951
    center = rng.normal(size=dim)
    center /= np.linalg.norm(center)
    off = lambda: (lambda v: v / np.linalg.norm(v))((lambda v: v - (v @ center) * center)(rng.normal(size=dim)))
    rows = []
    for k in range(n):
        side = off()
        a = np.sqrt(0.85) * center + np.sqrt(0.15) * side
        rows.append((2 * k, a.tolist()))
        if k < 150:
            other = off()
            other -= (other @ side) * side
            other /= np.linalg.norm(other)
            inner = 1 - (1 - cosine) / 0.15
            rows.append((2 * k + 1, (np.sqrt(0.85) * center + np.sqrt(0.15) * (inner * side + np.sqrt(1 - inner**2) * other)).tolist()))
    want = brute(rows)
    for bits in (None, 4):  # as measured, and in runs of many passes
        if bits is not None:
            monkeypatch.setattr(E, "_prefix_bits", lambda sample, n, bits=bits: bits)
        got = run(spark, rows)
        found, there = sum(r[1] for r in got), sum(r[1] for r in want)
        assert there >= 300 and 0.98 * there <= found <= there


def test_pairs_do_not_depend_on_the_size_of_the_table(spark, monkeypatch):
    """Pairs at the threshold, many of which few passes miss, alone and among others: the same ones are found."""
    monkeypatch.setattr(E, "WINDOW", 4)
    monkeypatch.setattr(E, "ROW", 100)
    monkeypatch.setattr(E, "MISSED", 0.2)
    rng = np.random.default_rng(8)
    pairs, dim = [], 32
    for k in range(500):
        a = rng.normal(size=dim)
        a /= np.linalg.norm(a)
        b = rng.normal(size=dim)
        b -= (a @ b) * a
        pairs += [(2 * k, a.tolist()), (2 * k + 1, (0.9502 * a + np.sqrt(1 - 0.9502**2) * b / np.linalg.norm(b)).tolist())]
    others = [(k, v) for k, v in enumerate(rng.normal(size=(5000, dim)).tolist(), 1000)]
    alone, among = run(spark, pairs), run(spark, pairs + others)
    assert 0.75 * len(pairs) <= sum(r[1] for r in alone) < len(pairs)
    assert sorted(r for r in among if r[0] < 1000) == sorted(alone)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(5, [1.0, 2.0]), (5, [1.0, 2.0]), (3, [2.0, 4.0]), (1, None), (2, [1.0, None]), (4, [nan, 1.0]), (None, [1.0, 2.0]),
            (7, [0.0, 0.0]), (8, [1.0]), (9, []), (10, [1e38, 2e38]), (11, [1e-30, 2e-30])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
