"""Tokenizer files of the public libraries inside tasks, and where a text may be cut before encoding.

The driver reads a file, whose size is fixed, and broadcasts its bytes; a worker loads them once.

A cut is safe where encoding both sides apart gives the same tokens as encoding the whole:

- before a space or line end that follows a visible character, for all three kinds: words of the .json
  files never reach back over white space, special strings hold none, and no piece of a .model file has
  its space mark behind another character (checked on loading). A .model file puts a space before each
  text, so there the right side loses the one it was cut at, only spaces count, and something has to follow;
- for .json files also between a letter and a plain sign, where words end too.

A file whose rules are none of these is never cut, and neither is a run without a safe place.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

from fleetgauge.llm.bpe import byte_letters

#: Characters of a piece of a long text; bytes of text in one call of the library.
PIECE, BATCH = 1 << 16, 1 << 19
#: Signs that end a word of letters and are part of no special string.
_SIGNS = r"[!-&(-/:;=?@\[-`{}~。、，！？；：]"
_SPACE, _LINE = r"(?<=[!-~\w]) (?=(?s:.))", r"(?<=[!-~\w])[ \n]"
_WORDS = rf"{_LINE}|(?<=[^\W\d_]){_SIGNS}"


def _pre_tokenizers(spec: dict) -> list[dict]:
    first = spec.get("pre_tokenizer") or {}
    return first.get("pretokenizers", [first])


def _cuts_words(spec: dict) -> bool:
    """Whether words of a .json file end at white space and between letters and signs."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or regex.search(_WORDS, t["content"]) for t in spec["added_tokens"]):
        return False
    if any(n["type"] not in ("NFC", "Lowercase", "Replace") for n in _normalizers(spec)):
        return False
    if any(n["type"] == "Replace" and n["pattern"] != {"Regex": "\\s+"} for n in _normalizers(spec)):
        return False
    kinds = _pre_tokenizers(spec)
    if any(k["type"] == "ByteLevel" and k["use_regex"] and not k["add_prefix_space"] for k in kinds):
        return len(kinds) == 1
    return any(k["type"] == "Split" and k["invert"] and "[^\\s\\p{L}\\p{N}]+" in k["pattern"].get("Regex", "") for k in kinds)


def _normalizers(spec: dict) -> list[dict]:
    first = spec.get("normalizer")
    return [] if first is None else first.get("normalizers", [first])


class Encoder:
    """One tokenizer file: counts and ids of pieces. plain: special strings are ordinary text."""

    def __init__(self, name: str, data: bytes, plain: bool):
        # Tasks are as many as cores; threads of the library's own would take turns with them.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.model = name.endswith(".model")
        if self.model:
            from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

            self.coder, proto = SentencePieceProcessor(model_proto=data), sentencepiece_model_pb2.ModelProto()
            proto.ParseFromString(data)
            rules = proto.normalizer_spec
            whole = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
            whole = whole and not proto.trainer_spec.treat_whitespace_as_suffix
            safe = whole and not any("▁" in p.piece.lstrip("▁") for p in proto.pieces)
            self.cut = regex.compile(f"(?r){_SPACE}") if safe else None
        else:
            from tokenizers import Tokenizer

            spec = json.loads(data)
            self.coder = Tokenizer.from_str(data.decode())
            self.coder.encode_special_tokens = plain
            self.coder.no_truncation()
            self.coder.no_padding()
            self.cut = regex.compile(f"(?r){_WORDS}") if _cuts_words(spec) else None

    def pieces(self, text: str, size: int = PIECE) -> Iterator[str]:
        """The text in pieces of at most `size` characters where safe places allow."""
        return safe_pieces(text, self.cut, size, self.model)

    def calls(self, texts: Iterable[str | None], piece: int = PIECE, batch: int = BATCH) -> Iterator[tuple[list[int], list[str]]]:
        """Pieces of the texts that have any, and the rows they belong to, in calls of about `batch` bytes."""
        rows, pieces, size = [], [], 0
        for row, text in enumerate(texts):
            for part in self.pieces(text, piece) if text else ():
                n = len(part.encode())
                if pieces and size + n > batch:
                    yield rows, pieces
                    rows, pieces, size = [], [], 0
                rows.append(row)
                pieces.append(part)
                size += n
        if pieces:
            yield rows, pieces

    def encoded(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        out: list[list[int]] = [[] for _ in texts]
        for rows, pieces in self.calls(texts):
            for row, ids in zip(rows, self.ids(pieces), strict=True):
                if out[row]:
                    out[row].extend(ids)
                else:
                    out[row] = ids
        return out

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id: byte-level entries decoded, space marks as spaces, byte pieces as their byte."""
        if self.model:
            names = (self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size()))
            return [
                bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(names)
            ]
        letters, vocab = byte_letters(), self.coder.get_vocab()
        entries = {i: e for e, i in vocab.items()}
        return [
            bytes(letters[c] for c in entries[i]) if i in entries and set(entries[i]) <= letters.keys() else entries.get(i, "").encode()
            for i in range(max(entries) + 1)
        ]

    def size(self) -> int:
        """Ids of the vocabulary."""
        return self.coder.get_piece_size() if self.model else max(self.coder.get_vocab().values()) + 1

    def counts(self, pieces: list[str]) -> list[int]:
        if self.model:
            return [len(ids) for ids in self.coder.encode(pieces, num_threads=1)]
        return [len(e) for e in self.coder.encode_batch_fast(pieces, add_special_tokens=False)]

    def ids(self, pieces: list[str]) -> list[list[int]]:
        if self.model:
            return self.coder.encode(pieces, num_threads=1)
        return [e.ids for e in self.coder.encode_batch_fast(pieces, add_special_tokens=False)]


def safe_pieces(text: str, cut: regex.Pattern | None, size: int = PIECE, lose_space: bool = False) -> Iterator[str]:
    """Cut at the last match of the backward pattern `cut` in each window of `size`, else at the first one behind it."""
    at, end = 0, len(text)
    while cut is not None and end - at > size:
        found, reach = cut.search(text, at + 1, at + size), at + size
        while found is None and reach < end:  # no safe place: look on, a window at a time
            found, reach = cut.search(text, reach - 1, min(end, reach + size)), reach + size
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start() + lose_space
    yield text[at:]


@lru_cache(maxsize=4)
def _loaded(name: str, data: bytes, plain: bool) -> Encoder:
    return Encoder(name, data, plain)


class SharedFile:
    """A tokenizer file on its way to the tasks."""

    def __init__(self, spark: SparkSession, path: str, plain: bool = False):
        with open(path, "rb") as f:
            self.data: Broadcast[bytes] = spark.sparkContext.broadcast(f.read())
        self.name, self.plain = path.rsplit("/", 1)[-1], plain

    def encoder(self) -> Encoder:
        return _loaded(self.name, self.data.value, self.plain)
