import random

from fleetgauge.llm import language
from fleetgauge.llm.language import document_rows, identify, identify_tables, kept_documents, page_rows

SCHEMA = "doc_id long, text string, lang string, source string, language string"
SYLLABLES = {"aa": "ka lo mi pe tu na", "bb": "sch ung eit ber ver gen", "cc": "ción ado ñ que era los"}


def text(rng, lang, words=60):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def corpus(seed, n=600, wrong=0.1):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        said = rng.choice(sorted(SYLLABLES)) if rng.random() < wrong else lang
        rows.append((d, text(rng, lang, rng.choice([1, 3, 60])), said, "host-" + (lang if d % 3 else "x"), lang))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1)
    got = {r.doc_id: r for r in identify(document_rows(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert len(got) == len(rows) and all(r.kept for r in got.values())
    assert sum(got[d].language == lang for d, _, _, _, lang in rows) >= 0.97 * len(rows)
    assert all(r.declared == said for (d, _, said, _, _) in rows for r in [got[d]])


def test_noise_is_rejected_and_the_rest_kept(spark):
    rng = random.Random(2)
    rows = corpus(3, 300)
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=4000))
    rows.append((1000, noise, None, "host-x", "n"))
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in kept_documents(df).collect()) == list(range(300))
    assert kept_documents(df).columns == df.columns


def test_priors_decide_without_text(spark):
    rows = corpus(4, 300) + [(2000, None, None, "host-aa", ""), (2001, "", "bb", None, ""), (2002, "?!", "cc", "new", "")]
    got = {r.doc_id: r for r in identify(document_rows(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert [got[d].language for d in (2000, 2001, 2002)] == ["aa", "bb", "cc"]


def scripts(rng, k, words):
    """Words of a script of its own for each k."""
    return " ".join("".join(chr(0x4E00 + 100 * k + rng.randrange(60)) for _ in range(5)) for _ in range(words))


def test_every_declared_language_counts(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(100 * k + d, scripts(rng, k, 60), f"l{k:02}", "h", f"l{k:02}") for k in range(40) for d in range(4 if k > 32 else 8)]
    rows += [(9000 + d, scripts(rng, 50, 4000), "long", "h", "long") for d in range(3)]
    rows += [(9100 + d, scripts(rng, 51, 60), said, None, "xx") for d, said in enumerate(["xx", "XX", "xx-US", "xx", "xx", None])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in identify(document_rows(df)).collect()}
    assert all(r.kept for r in got.values()) and all(got[d].language == lang for d, _, _, _, lang in rows)
    monkeypatch.setattr(language, "LANGUAGES", 5)  # labels without a class are taken as they are
    got = {r.doc_id: r for r in identify(document_rows(df)).collect()}
    assert all(got[d].kept and got[d].language == said for d, _, said, _, _ in rows if d < 9100)


def test_odd_tables(spark):
    assert identify(document_rows(spark.createDataFrame([], SCHEMA))).collect() == []
    rows = [(1, "abc", None, None, ""), (1, "abc", None, None, ""), (None, None, None, None, "")]
    got = identify(document_rows(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(got) == 3 and all(r.language is None and r.kept for r in got)
    long = [(1, "ka lo mi " * 300_000, "aa", "h", ""), (2, "ka lo", "aa", "h", ""), (3, "sch ung", "bb", "h", "")]
    assert identify(document_rows(spark.createDataFrame(long, SCHEMA))).filter("language = 'aa'").count() == 2


def test_pages(spark):
    rng = random.Random(5)
    rows = []
    for d in range(200):
        lang = rng.choice(sorted(SYLLABLES))
        html = f"<html lang={lang}><script>var x='schschsch'</script><p>{text(rng, lang, 3)}</p>"
        rows.append((d, f"http://h{d % 5}.{lang}/p", html))
    rows += [(500, None, None), (501, "no address", "")]
    got = {r.doc_id: r for r in identify(page_rows(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()}
    assert len(got) == 202
    assert all(got[d].language == url.split("/")[2].split(".")[1] for d, url, _ in rows[:200])


def test_suffix_decides_for_new_hosts(spark):
    """A page without text, markup or a known host follows its suffix; a document without them its corpus."""
    rng = random.Random(9)
    rows = [(d, f"http://h{d % 7}.{lang}/p", f"<p>{text(rng, lang, 30)}") for d in range(300) for lang in [rng.choice(["aa", "bb"])]]
    said = [(1000 + d, f"http://h.{lang}/", f"<html lang={lang}><p>{text(rng, lang, 30)}") for d in range(40) for lang in ["aa" if d % 2 else "bb"]]
    new = [(2000, "http://new.aa/x", "<script>schungeit"), (2001, "https://me@new.bb:80/", None)]
    pages = spark.createDataFrame(rows + said + new, "page_id long, url string, html string")
    docs = spark.createDataFrame([(1, "ka lo mi pe " * 9, "aa", "s"), (2, None, None, "s")], "doc_id long, text string, lang string, source string")
    got = identify_tables(docs, pages).collect()
    assert len(got) == 344 and {r.table for r in got} == {"documents", "pages"}
    of = {r.page_id: r.language for r in got if r.table == "pages"}
    assert all(r.doc_id is None for r in got if r.table == "pages") and all(r.page_id is None for r in got if r.table == "documents")
    assert (of[2000], of[2001]) == ("aa", "bb")
    assert sum(of[d] == url.rsplit(".", 1)[1][:2] for d, url, _ in rows) >= 295


def test_broken_markup(spark):
    """Unclosed scripts and comments, and tags without end, in pages of a megabyte."""
    odd = ["<script>" * 100_000, "<!-- " * 200_000, "<" * 1_000_000, "<html " * 150_000, "<p>ka lo<!-- x --> mi</p><style>a{}</style >pe tu"]
    rows = page_rows(spark.createDataFrame([(k, None, h) for k, h in enumerate(odd)], "page_id long, url string, html string")).collect()
    assert rows[4].text.split() == ["ka", "lo", "-->", "mi", "pe", "tu"]
    assert all(not any(c.isalpha() for c in r.text) for r in rows[:3])
