"""Token counts of whole texts: Arrow batches in, lengths out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import byte_slices, id_and_text
from varloom.llm.encoding import chunk_encoder

#: Texts are encoded in batches of so many bytes; a longer text is cut at safe places.
BATCH_BYTES = 8 << 20


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Ids never leave the worker. Null texts are empty and have no tokens; rows
    with equal ids stay separate rows; a null id stays null. The scan's splits
    are the tasks, so there is no exchange.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(tokenizer)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            texts = batch.column("text")
            _, ends = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(np.diff(ends, prepend=0), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    counted = id_and_text(docs, doc_id, text).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
