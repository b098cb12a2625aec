"""Token counts: batches of equal bytes through the tokenizer library, lengths only.

Rows are taken in slices of about BATCH bytes of text, and one call of the library encodes a slice, so a
batch costs the same whatever the lengths of its texts. Only the number of tokens leaves the library: ids
never become Python or Arrow values. A text longer than PIECE characters goes in pieces, cut where no token
can reach across (tokenizer_files), in several calls of BATCH bytes; its count is the sum over them. Memory
is one call's encodings, but for a run of text without any safe place, which is encoded whole.

A null or empty text has 0 bytes and 0 tokens. doc_id may repeat or be null; a row gives a row. Columns
other than doc_id and text are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.shared import column, slices
from fleetgauge.llm.tokenizer_files import BATCH, PIECE, Encoder, SharedFile

def lengths(encoder: Encoder, texts: pa.Array, piece: int = PIECE, batch: int = BATCH) -> np.ndarray:
    """Tokens of each text."""
    out = np.zeros(len(texts), dtype=np.int64)
    for rows, pieces in encoder.calls((t.as_py() for t in texts), piece, batch):
        np.add.at(out, rows, encoder.counts(pieces))
    return out


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each text; tokenizer: path of a .json or .model file."""
    shared = SharedFile(documents.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.encoder()
        for batch in slices(batches, "text", BATCH):
            texts = column(batch, "text")
            n = lengths(encoder, texts)
            size = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), size, pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
