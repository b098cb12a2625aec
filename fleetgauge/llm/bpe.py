"""Byte-level BPE as a streaming transducer, and its way back.

Encoding reads a text once, window by window. Words (runs by the vocabulary's pattern) are final as
soon as two characters follow them. Each word runs through a transducer over its bytes: for each
position it keeps the last token of the prefix that ends there, which is the one token that ends there
and whose pair with the token before it is a pair that merging leaves alone. No token is longer than
the merge list's longest, LOOKAHEAD bytes; so once the chains of the last LOOKAHEAD positions meet in
one boundary, what is before it can't change any more, and it is emitted and forgotten. What the
transducer gave for a word of up to SHORT bytes is remembered for when the word comes again (a full memory
keeps the words that came up since it was half full), and so are the last tokens of its prefixes, for
when another word begins alike. Memory is the window, the positions since that boundary and a bounded
memory of words and prefixes, which goes when a task ends: workers live on in other stages.
Plain merging serves to tell the tokens and pairs that merging leaves alone, never to encode a text.

Decoding feeds token bytes to an incremental UTF-8 machine that keeps at most three pending bytes;
bytes that are no UTF-8 give U+FFFD.

A null text counts as empty: no tokens. Special strings in a text are special tokens. Rows keep their
doc_id, repeated or null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, slices

#: How byte-level vocabularies cut texts into words (a fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a window, bytes of a word that is remembered, words remembered; as many of their prefixes are.
WINDOW, SHORT, WORDS = 1 << 16, 64, 1 << 18
#: Rank of a pair that is never merged; how a single byte comes about.
NONE, _BYTE = 1 << 40, (-1, 0, 0)
#: Parts of what is remembered of a word.
_IDS, _LINE = itemgetter(0), itemgetter(1)


def byte_letters() -> dict[str, int]:
    """The format's letter for each byte: printable Latin-1 is itself, the others follow 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Coder:
    """Merge list and vocabulary of a tokenizer file, with both directions of the transducer."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters, model = byte_letters(), spec["model"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        vocab = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        pairs = list(pairs)
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.parts = {i: (k, vocab[a], vocab[b]) for k, (i, (a, b)) in enumerate(zip(self.made, pairs, strict=True))}
        # Whether tokens come about in the order of the list, each by one rule.
        self.ordered = len(self.parts) == len(self.made) and all(
            k > self.parts.get(i, _BYTE)[0] for k, *both in self.parts.values() for i in both)
        self.byte_id = [0] * 256
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        self.lookahead = max(len(self.bytes_of[i]) for i in self.made)
        self.words = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.ends: dict | None = None
        self.whole: dict[bytes, int] = {}
        self.begun: dict[bytes, int] = {}

    def merged(self, data: bytes) -> list[int]:
        """Merge the bytes of one or two tokens: the earliest rule of the list first, then the leftmost pair."""
        ids = [self.byte_id[b] for b in data]
        rank = self.rank.get
        ranks = [rank(p, NONE) for p in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) != NONE:
            at = ranks.index(least)
            ids[at : at + 2] = [self.made[least]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), NONE)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), NONE)
        return ids

    def _stays(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two."""
        if len(self.pairs) > WORDS:
            self.pairs.clear()
        self.pairs[a, b] = found = self._never_meet(a, b) if self.ordered else self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def _never_meet(self, a: int, b: int) -> bool:
        """Take the merges next to the border back, the latest first: no rule may join what then faces it in time.

        A rule of the same rank is in time left of the merge taken back, not right of it.
        """
        limit = NONE
        while True:
            if self.rank.get((a, b), NONE) < limit:
                return False
            (ka, _, inner_a), (kb, inner_b, _) = self.parts.get(a, _BYTE), self.parts.get(b, _BYTE)
            if ka > kb:
                a, limit = inner_a, ka
            elif kb >= 0:
                b, limit = inner_b, kb + 1
            else:
                return True

    def _tokens_ending(self) -> dict:
        """Tokens by their bytes backwards, as nested tables; None holds the token itself."""
        if self.ends is None:
            self.ends = {}
            for i in {*self.byte_id, *self.made}:
                if self.merged(self.bytes_of[i]) == [i]:
                    node = self.ends
                    for b in reversed(self.bytes_of[i]):
                        node = node.setdefault(b, {})
                    node[None] = self.whole[self.bytes_of[i]] = i
        return self.ends

    def stream(self, data: bytes) -> Iterator[int]:
        """Tokens of a word, each as soon as no later byte can change it."""
        ends, last, base = self._tokens_ending(), [-1], 0  # last[k]: last token of the prefix of base + k bytes
        if not self.begun or len(self.begun) > WORDS:
            self.begun = self.whole.copy()
        pairs, begun, size, reach = self.pairs, self.begun, len(data), self.lookahead
        short, far = size <= SHORT, 32 * reach
        for end in range(1, size + 1):
            head = data[:end] if end <= reach else None
            found = begun.get(head) if head else None  # one token from the start, or known
            node, at = ends, end
            while found is None and at > base and (node := node.get(data[at - 1])) is not None:
                at -= 1
                if None in node and at and (before := last[at - base]) is not None:
                    stays = pairs.get((before, node[None]))
                    if stays or stays is None and self._stays(before, node[None]):
                        found = node[None]
                        if head and short:
                            begun[head] = found
            last.append(found)
            if end == size or len(last) > far:
                heads = {end} if end == size else {p for p in range(end - reach + 1, end + 1) if last[p - base] is not None}
                while len(heads) > 1 and max(heads) > base:  # walk the chains back until they meet
                    p = max(heads)
                    heads.discard(p)
                    heads.add(p - len(self.bytes_of[last[p - base]]))
                meet, out = max(heads), []
                p = meet
                while p > base:
                    out.append(last[p - base])
                    p -= len(self.bytes_of[out[-1]])
                yield from reversed(out)
                last, base = last[meet - base :], meet

    def _word(self, word: str) -> tuple[tuple[int, ...], str]:
        found = self.older.get(word)
        if found is None:
            data = word.encode()
            ids = tuple(self.stream(data))
            found = (ids, ",".join(map(str, ids)))
            if len(data) > SHORT:
                return found
        if 2 * len(self.known) >= WORDS:
            self.older = self.known.copy()
            self.known.clear()
        self.known[word] = found
        return found

    def forget(self) -> None:
        """Give the memory of words, pairs and prefixes back."""
        self.known, self.older, self.pairs, self.begun = {}, {}, {}, {}

    def _windows(self, text: str) -> Iterator[list[str]]:
        """Words of a text without special strings, window by window."""
        at, reach = 0, WINDOW
        while at < len(text):
            part = text[at : at + reach]
            final = at + reach >= len(text)
            if final:
                yield self.words.findall(part)
                return
            found, stop = [], 0
            for m in self.words.finditer(part):
                if m.end() > len(part) - 2:  # another character or two could change this word
                    break
                found.append(m.group())
                stop = m.end()
            reach = WINDOW if stop else reach * 2
            at += stop
            if found:
                yield found

    def encode(self, text: str) -> Iterator[tuple[list[int] | tuple[int, ...], str]]:
        """Pieces of the encoding in order: ids, and the same as decimal text joined by commas."""
        at = 0
        for m in self.specials.finditer(text) if self.specials and "<" in text else ():
            yield from self._plain(text[at : m.start()])
            yield (self.special[m.group()],), str(self.special[m.group()])
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[tuple[list[int], str]]:
        known = self.known
        for words in self._windows(text):
            found = [known.get(w) or self._word(w) for w in words]
            yield list(chain.from_iterable(map(_IDS, found))), ",".join(map(_LINE, found))

    def decode(self, pieces: Iterator[list[int]]) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in pieces:
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))
        yield machine.decode(b"", True)


@lru_cache(maxsize=2)
def _coder(text: str) -> Coder:
    return Coder(text)


def _file(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_digests(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text; tokenizer: path of its file.

    The driver reads the file, whose size is fixed, and broadcasts it.
    """
    shared = documents.sparkSession.sparkContext.broadcast(_file(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in slices(batches, "text"):
            rows = [_row(coder, t or "") for t in column(batch, "text").to_pylist()]
            n, ids, texts = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        coder.forget()

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_lists(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids array<int>) of each text."""
    shared = documents.sparkSession.sparkContext.broadcast(_file(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in slices(batches, "text"):
            ids = [list(chain.from_iterable(p[0] for p in coder.encode(t or ""))) for t in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])
        coder.forget()

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, ids array<int>")


def texts_of(tokens: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the way back; null ids give an empty text."""
    shared = tokens.sparkSession.sparkContext.broadcast(_file(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            texts = ["".join(coder.decode(iter([x or []]))) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")


def _row(coder: Coder, text: str) -> tuple[int, str, str]:
    """Number of tokens and both digests, piece by piece."""
    ids_hash, text_hash, count = hashlib.sha256(), hashlib.sha256(), 0

    def seen() -> Iterator[list[int]]:
        nonlocal count
        for ids, line in coder.encode(text):
            if ids:
                ids_hash.update(("," + line if count else line).encode())
                count += len(ids)
                yield ids

    decode: Callable[[Iterator[list[int]]], Iterator[str]] = coder.decode
    for piece in decode(seen()):
        text_hash.update(piece.encode())
    return count, ids_hash.hexdigest(), text_hash.hexdigest()
