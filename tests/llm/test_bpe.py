import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetgauge.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe._file(PATH))


def texts():
    rng = random.Random(5)
    marks = list("abcdeéüñß漢字🙂 \n\t\r\x0b\x0c\x1c\x1f\x85\xa0 ​'.,!0123456789<|>-=_*&%$﻿́") + ["'re", "<|endoftext|>", "  ", "the ", "ing"]
    out = ["".join(rng.choices(marks, k=rng.choice([0, 1, 2, 5, 30, 300]))) for _ in range(400)]
    for unit in ("a", "ab", "the", "-", "=", " ", "\n", "é", "漢", "0", "abc!", "aaab", "🙂"):
        out += [unit * k for k in (63, 64, 65, 200, 5000)]
    letters = "etaoinshrdlu"
    out += ["".join(rng.choices(letters, k=k)) for k in (65, 300, 5000, 140_000)]
    out.append(" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(["", "'s", ".", "\n", "  "]) for _ in range(40_000)))
    return out


def test_tokens_equal_the_library(coder, library):
    for text in texts():
        ids = [i for piece, _ in coder.encode(text) for i in piece]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:50]
        assert "".join(coder.decode(iter([[i] for i in ids]))) == library.decode(want, skip_special_tokens=False) == text


def test_windows_do_not_matter(coder, library, monkeypatch):
    sample = texts()[:300]
    for size in (3, 7, 64):
        monkeypatch.setattr(bpe, "WINDOW", size)
        for text in sample:
            ids = [i for piece, _ in coder.encode(text) for i in piece]
            assert ids == library.encode(text, add_special_tokens=False).ids


def test_decoding_broken_bytes(coder, library):
    rng = random.Random(6)
    for _ in range(200):
        ids = rng.choices(range(256), k=12)
        assert "".join(coder.decode(iter([[i] for i in ids]))) == library.decode(ids, skip_special_tokens=False)


def test_stream_emits_before_the_end(coder):
    got = coder.stream(b"ab" * 100_000)
    assert next(got) in coder.bytes_of  # and the rest is not needed for it


def test_queries(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello <|endoftext|> world", None), (3, "Hello", "y"), (None, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.token_digests(df, PATH).collect()
    assert len(got) == 5
    for (d, t, _), r in zip(rows, got, strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (r.doc_id, r.n_tokens) == (d, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = bpe.texts_of(bpe.token_lists(df, PATH), PATH).collect()
    assert [(r.doc_id, r.text) for r in back] == [(d, t or "") for d, t, _ in rows]
    assert bpe.token_digests(df.limit(0), PATH).collect() == []


def test_a_full_memory_keeps_common_words_and_tokens_stay_right(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 60)
    own, ran = bpe.Coder(bpe._file(PATH)), []
    monkeypatch.setattr(own, "stream", lambda data: ran.append(data) or bpe.Coder.stream(own, data))
    rng = random.Random(7)
    rare = (" " + "".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(2000))
    text = "".join(" common" + word for word in rare)
    ids = [i for piece, _ in own.encode(text) for i in piece]
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert ran.count(b" common") == 1


def test_prefixes_are_remembered(coder):
    list(coder.stream(b" vonerbetezu"))
    assert [coder.begun[b" vonerbetezu"[:k]] for k in (11, 12)] == [coder.merged(b" vonerbetezu"[:k])[-1] for k in (11, 12)]


def test_nothing_is_remembered_between_tasks():
    own, rng = bpe.Coder(bpe._file(PATH)), random.Random(8)
    list(own.encode(" ".join("".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(3000))))
    assert len(own.known) > 2000 and len(own.pairs) > 2000
    own.forget()
    assert not (own.known or own.older or own.pairs or own.begun)
    assert [i for piece, _ in own.encode("etaoin shrdlu") for i in piece] == own.merged(b"etaoin") + own.merged(b" shrdlu")
