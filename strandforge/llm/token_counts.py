"""Token counts by rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, tune
from .ragged_bpe import load


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Words of a batch are merged together: in each step every word's lowest-rank pair, until none is left.
    Special strings inside a text count one token each; nothing is added, cut or padded. A null or empty text
    has 0 bytes and 0 tokens; ids may be null or repeat, each row is counted for itself. Other columns are
    ignored; an empty table gives an empty table. A narrow stage: no shuffle, memory bounded by one Arrow batch.
    """
    tune(docs.sparkSession)

    def run(batches):
        bpe = load(tokenizer_path)
        for b in batches:
            n = bpe.counts([x or "" for x in b["text"].to_pylist()])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_bytes"], pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.mapInArrow(lean(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
