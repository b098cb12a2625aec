import hashlib
import random
import zlib

import pytest

from fleetgauge.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    values = [r[0], r[1], r[2], r[3], text]
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, i):
    """(left, right) of each level."""
    out = []
    for nodes in tree[:-1]:
        run = i // 16 * 16
        out.append((nodes[run:i], nodes[i + 1 : run + 16]))
        i //= 16
    return out


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[s] = levels([leaf(r, r[4]) for r in by_source[s]])
    top = levels([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for k, s in enumerate(names):
        for i, r in enumerate(by_source[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            proof = h(x for a, b in path for x in a + b)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, lowered(r[4]) if tampered else r[4])
            for a, b in path:
                node = h([*a, node, *b])
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], root, proof, node, node == root))
    return out


def check(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    got = M.prove_documents(docs).collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(brute(rows), key=key)
    return got


def document(rng, d, source):
    text = rng.choice([None, "", "all low", "Some Text É ÀZ", "long " * 400, f"Doc {d}"])
    return (d, source, rng.choice(["en", None, "日本"]), rng.choice([None, d or 0, -3]), text)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    sizes = {"a": 1, "b": 15, "c": 16, "d": 17, None: 40, "": 257, "é": 2, "z": 3, "Z": 300, **{f"s{i:02}": 1 + i % 5 for i in range(20)}}
    ids = iter(rng.sample(range(100000), sum(sizes.values())))
    rows = [document(rng, next(ids), s) for s, n in sizes.items() for _ in range(n)]
    got = check(spark, rows)
    assert {r.verified for r in got} == {True, False}


def test_several_builders_and_a_hot_source(spark):
    rng = random.Random(4)
    rows = [document(rng, d, "hot" if d % 10 else f"s{d % 7}") for d in range(9700)]
    check(spark, rows, 5)


def test_repeated_rows_and_null_ids(spark):
    rng = random.Random(5)
    rows = [(7, "s", "en", 4, "Same")] * 600 + [document(rng, None, "s") for _ in range(30)] + [document(rng, 7, "s") for _ in range(5)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_empty_and_single(spark, rows):
    if rows:
        got = check(spark, rows)
        assert got[0].proof_sha256 == h([]) and got[0].root == got[0].leaf == got[0].subroot
    else:
        docs = spark.createDataFrame([], SCHEMA)
        assert M.prove_documents(docs).collect() == []


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 100, 256, 257, 1000, 4095, 4096])
def test_places_are_those_of_the_log(leaves):
    top = M.height(leaves)
    builder, nodes = M.Builder(top), [f"{i:064}".encode() for i in range(leaves)]
    for n in nodes:
        builder.add(n)
    log = builder.close()
    assert len(log) == M.HEX * M.tree_size(leaves, top)
    for level, row in enumerate(levels([n.decode() for n in nodes])):
        for i, node in enumerate(row):
            at = M.position(level, i, leaves, top) * M.HEX
            assert log[at : at + M.HEX].decode() == node


def test_places_run_over_builders():
    """A tier's log is the builders' segments one behind the other, with the same closed form."""
    leaves, start = 3 * M.CHUNK + 700, 0
    for b in range(4):
        assert start == b * M.tree_size(M.CHUNK, M.TIER)
        mine = min(M.CHUNK, leaves - b * M.CHUNK)
        for level in range(M.TIER + 1):
            first = b * M.CHUNK // M.FAN**level
            assert M.position(level, first, leaves) == start + M.position(level, 0, mine)
        start += M.tree_size(mine, M.TIER)
