import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from test_token_counts import ODD, mixed
from tokenizers import Tokenizer

from fleetgauge.llm.alignment import align_documents, linked_documents, pair_totals
from fleetgauge.llm.bpe import byte_letters

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def brute():
    """Rows of documents by a loop over whole texts."""
    first, second = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    letters = byte_letters()

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        one = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, piece(i)) for i in second.encode(text)]
        want = (" " + text).encode()
        return (one, two) if b"".join(x for _, x in one) == want == b"".join(x for _, x in two) else ([], [])

    def ends(side):
        at, out = 0, {}
        for i, x in side:
            at += len(x)
            out[at] = i
        return out

    def run(rows):
        found = [(d, *tokens(t)) for d, t in rows]
        links = [[(x[e], y[e]) for e in sorted(x.keys() & y.keys())] for x, y in ((ends(a), ends(b)) for _, a, b in found)]
        count = Counter(p for row in links for p in row)
        best = defaultdict(int)
        for (_, b), n in count.items():
            best[b] = max(best[b], n)
        out = []
        for (d, a, b), row in zip(found, links, strict=True):
            cuts, groups = sorted(ends(a).keys() & ends(b).keys()), []
            rest = [list(ends(side).items()) for side in (a, b)]
            for e in cuts:
                ids = [[], []]
                for mine, left in zip(ids, rest, strict=True):
                    while left and left[0][0] <= e:
                        mine.append(str(left.pop(0)[1]))
                groups.append("|".join(map(",".join, ids)))
            sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
            n_best = sum(count[p] == best[p[1]] for p in row)
            out.append((d, len(a), len(b), len(cuts), len(row), n_best, sum(count[p] for p in row), sha))
        return out, count

    return run


def same(got, want):
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_equals_brute_force(spark, brute):
    rng = random.Random(11)
    texts = [*ODD, None, "same text here", "same text here", *(mixed(rng, rng.randint(1, 60)) for _ in range(200))]
    texts += [" ".join(rng.choices(["the", "model", "Learning", "naïve", "of", "tokens,", "x1"], k=rng.randint(1, 80))) for _ in range(100)]
    rows = [(None if i % 50 == 7 else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, 1, "b") for r in rows], "doc_id long, text string, pair int, block string").repartition(3)
    want, count = brute(rows)
    same(align_documents(docs, A, B).select(*NAMES).collect(), want)
    totals = pair_totals(linked_documents(docs, A, B), 32000).collect()
    assert {(r.pair // 32000, r.pair % 32000): r.total for r in totals} == count


def test_long_text_and_repeated_rows(spark, brute):
    long = "Many words, of one text. " * 6000
    rows = [(1, long), (1, "of one text"), (1, "of one text"), (2, "x" * 3000), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    same(align_documents(docs, A, B).select(*NAMES).collect(), brute(rows)[0])


def test_without_any_token(spark):
    rows = [(1, None), (2, ""), (3, "▁")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(align_documents(docs, A, B).select(*NAMES).collect(), [(d, 0, 0, 0, 0, 0, 0, "") for d, _ in rows])
    assert align_documents(spark.createDataFrame([], docs.schema), A, B).collect() == []
