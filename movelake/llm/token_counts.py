"""Token counts: batch encoding in an Arrow function that returns lengths only.

Batches are cut by bytes, not rows, so a batch of long texts is no larger than
one of short ones. Texts are split at safe boundaries and each distinct piece
of a batch is encoded once by the tokenizers library; a bounded memory of
pieces serves the following batches.

Defined cases: a null or empty text has 0 bytes and 0 tokens; ids may be null
or repeat, each row is counted alone; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from movelake.llm import pieces
from movelake.llm.common import python_ready, whole

_KNOWN: dict[str, pieces.Known] = {}


def _lengths(path: str) -> pieces.Known:
    """One per worker process and tokenizer."""
    if path not in _KNOWN:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation(), t.no_padding()
        _KNOWN[path] = pieces.Known(lambda new: [len(e) for e in t.encode_batch_fast(new, add_special_tokens=False)])
    return _KNOWN[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = 4 << 20) -> DataFrame:
    """id, n_bytes, n_tokens per row of docs."""
    python_ready(docs.sparkSession)

    def run(batches):
        known = _lengths(path)
        for batch, texts in pieces.by_bytes(batches, "text", batch_bytes):
            parts = [pieces.cut(t) for t in texts]
            n = known.get(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([sum(map(n.__getitem__, p)) for p in parts], pa.int64())],
                ["id", "n_bytes", "n_tokens"])

    given = docs.select(F.col(id_col).alias("id"), F.octet_length(whole(text_col)).cast("long").alias("n_bytes"),
                        whole(text_col).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
