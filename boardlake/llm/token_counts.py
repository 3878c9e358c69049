"""Token counts of whole texts by a public tokenizer.

Texts reach the workers in Arrow batches whose bytes Spark limits
(``spark.sql.execution.arrow.maxBytesPerBatch``); inside, they are encoded in
groups of equal bytes, and long texts are cut at the safe places
of ``token_text``.  Only lengths come back.

Defined results: a null or empty text has no bytes and no tokens; strings of
special tokens inside a text count as the library's default has them; repeated
rows are counted each, in any order, so there are no ties; very long texts are
counted whole; an empty table gives no row; only the columns doc_id and text
are looked at, and a null doc_id is kept.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.llm.common import pick
from boardlake.llm.token_text import PieceEncoder, text_parts

#: Bytes encoded together, and the tokens a document may have before it is over the limit.
TEXT_BYTES, TOKEN_LIMIT = 4 << 20, 2048


def token_counts(docs: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs(doc_id, text)``."""
    rows = pick(docs, doc_id="doc_id", text="text")

    def run(batches):
        encoder = PieceEncoder(tokenizer, len, "len")
        for batch in batches:
            for part, texts in text_parts(batch, TEXT_BYTES):
                counts = [sum(parts) for parts in encoder.values(texts)]
                sizes = [len(t.encode("utf-8")) if t else 0 for t in texts]
                yield pa.record_batch([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                                      ["doc_id", "n_bytes", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
