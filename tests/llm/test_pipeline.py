import hashlib
import random

import public_tokenizers
import pytest
from test_lines import brute as without_repeats
from test_ngram_join import brute as groups
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(7)
    words = {"aa": [f"ka{i}lo" for i in range(300)], "bb": [f"schung{i}" for i in range(300)]}
    rows = []
    for d in range(160):
        lang = rng.choice(["aa", "bb"])
        lines = [" ".join(rng.choices(words[lang], k=30)) for _ in range(rng.randint(1, 4))]
        if rows and rng.random() < 0.3:
            lines = rng.choice(rows)[1].split("\n")
            if rng.random() < 0.5:
                parts = lines[0].split()
                parts[rng.randrange(len(parts))] = "changed"
                lines[0] = " ".join(parts)
        lines.append("All rights reserved here.")
        rows.append((d, "\n".join(lines), lang, f"s{d % 3}", 0))
    noise = "".join(rng.choices("bcdfghjklmnpqrtvwxyz ", k=4000))
    rows += [(900, noise, None, "s0", 0), (901, None, "aa", None, 0), (902, "", "bb", "s1", 0)]
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.cut(stage(spark, docs, folder))
        assert docs.columns == columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept["language_id"]) == set(before) - {900}
    lines = without_repeats(list(kept["language_id"].items()))
    lines = {d: t for d, t in lines.items() if (t or "").split() or t == kept["language_id"][d]}
    assert kept["line_dedup"] == lines and 901 in lines and 902 in lines
    assert set(kept["near_duplicates"]) == {d for d, _, c in groups(list(lines.items())) if d == c}
    mixed = corpus_pipeline.cut(corpus_pipeline.STAGES[3][1](spark, docs, folder))
    assert mixed.columns == columns
    size = lambda t: len((t or "").split())
    total = sum(size(t) for t in kept["near_duplicates"].values())
    taken = [(r.doc_id, r.text) for r in mixed.collect()]
    assert abs(sum(size(t) for _, t in taken) - 1.5 * total) <= 3 * max(size(t) for _, t in taken)
    assert all(1 <= sum(d == e for e, _ in taken) <= 2 and kept["near_duplicates"][d] == t for d, t in taken)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((d, len(e := library.encode(t, add_special_tokens=False).ids), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest()) for d, t in taken)
    got = corpus_pipeline.STAGES[4][1](spark, mixed, folder).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == want
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_repeated_rows_leave_one(spark):
    rows = [(1, "one two three four five six", "aa", "s", 27)] * 2 + [(1, "other words are in this one", "aa", "s", 27)]
    got = corpus_pipeline.near_duplicate_documents(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert [r.doc_id for r in got] == [1]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
