import hashlib
import random
import re

from fleetgauge.llm.pii import scan_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for order, (kind, p) in enumerate(PATTERNS.items()):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(p, text or "") if valid(kind, m[0])]
    return sorted(found)


def check(spark, rows, schema="doc_id long, text string"):
    got = scan_pii(spark.createDataFrame(rows, schema)).collect()
    want = []
    for d, t, *_ in rows:
        spans = brute(t)
        line = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        counts = tuple(sum(s[3] == k for s in spans) for k in PATTERNS)
        want.append((d, *counts, hashlib.sha256(line.encode()).hexdigest(), line))
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=key) == sorted((w[:6] for w in want), key=key)
    return got, want


def test_base_equals_brute_force(spark):
    rng = random.Random(1)
    bits = ["a@b.c", "x.y%z@", "foo@bar", "@", ".", "-", "+", "+1", " ", "  ", "1", "255", "256", "0", "007", "1.2.3.4", "é🙂", "(", ")", "\n", "4111111111111111",
            "4111 1111-1111 1111", "+1 (988) 555-2485", "_d@e.f", "word", "378282246310005", "\t"]
    rows = [(d, "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 10, 40])))) for d in range(600)]
    rows += [(5000, "a@b.c " * 700 + "end 1.2.3.4"), (5001, "a" * 3_000), (5002, "1" * 3_000), (5003, "+1 " + "(" * 100_000), (5004, "1.2." * 3_000), (5005, "x@y" + ".z" * 20_000)]
    got, want = check(spark, rows)
    by = {r.doc_id: r.spans for r in got}
    assert all(by[w[0]] == w[6] for w in want if w[0] >= 5000)


def test_contexts_discover_identifiers(spark):
    rng = random.Random(2)
    rows = [(d, f"words {rng.randrange(99)} reach me via phone +1 (2{d % 90:02d}) 555-{1000 + d} or the office") for d in range(1000, 1150)]
    rows += [(100 + d, f"reach me via phone 555-{7000 + d}, thanks") for d in range(3)]
    rows += [(200 + d, f"the year {1900 + d} was good; version {d}.1234") for d in range(80)]
    got, _ = check(spark, rows)
    by = {r.doc_id: r for r in got}
    assert [by[100 + d].spans for d in range(3)] == ["context:19:27"] * 3
    assert all(by[200 + d].spans == "" and by[200 + d].n_context == 0 for d in range(80))
    assert all(by[d].n_context == 0 and by[d].n_phone == 1 for d in range(1000, 1150))


def test_very_long_runs(spark):
    rows = [(1, "a" * 500_000), (2, "1" * 500_000), (3, "+1" * 200_000), (4, "é1 " * 100_000), (5, "@" * 300_000)]
    got = scan_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.spans == "" for r in got) and len(got) == 5


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a@b.c", None), (3, "a@b.c", "y"), (None, "1.2.3.4", "y")]
    check(spark, rows, "doc_id long, text string, base string")
    assert scan_pii(spark.createDataFrame([], "doc_id long, text string")).collect() == []
