"""Token counts of whole texts with a whole-token shortcut.

For byte-level BPE files, pre-tokens that are proven whole tokens count one without a merge and
the rest are merged once each (see ``bpe``); the table is proven once, on the driver, and broadcast. Sentencepiece models and other ``tokenizers`` files are
counted by their own library.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingmill.llm import bpe
from filingmill.llm.shared import broadcast_value, small_batches

_LIBRARY: dict = {}


def _other(path: str):
    """A counter by the file's own library."""
    if path not in _LIBRARY:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _LIBRARY[path] = lambda text: len(model.encode(text, num_threads=1))
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            _LIBRARY[path] = lambda text: len(library.encode(text, add_special_tokens=False).ids)
    return _LIBRARY[path]


def proven_table(path: str) -> dict[str, int] | None:
    """The whole-token table of a byte-level BPE file, None for other files; made on the driver, before the job."""
    try:
        return bpe.whole_tokens(path) if path.endswith(".json") else None
    except ValueError:
        return None


def counter(path: str, proven: dict[str, int] | None = None):
    """The token count of one text as a function, by the fastest way the file allows."""
    bpe.take(path, proven)
    if path.endswith(".json"):
        try:
            bpe.id_count(path, "")
            return lambda text: bpe.id_count(path, text)
        except ValueError:
            pass
    return _other(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text).

    doc_id is an integer; ``path`` names a vocabulary file that every executor has. Whole texts are counted, without
    begin, end or added special tokens; null and empty texts have none. Rows, repeated ones and
    null ids included, are kept one to one; other columns are ignored; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
    proven = broadcast_value(docs.sparkSession, proven_table(path))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, proven.value)
        for batch in batches:
            n = [count(t) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    return rows.mapInArrow(made, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
