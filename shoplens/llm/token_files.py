"""Token ids as Parquet list columns, in document order (op 5).

``write_tokens`` range-partitions the documents by doc_id, encodes them and
writes one row a document: ``doc_id, n_tokens, part, start_in_part, tokens``.
Encoding and layout are the writer's own, set by options: ``dictionary`` (16-bit
indexes of the ids that occur) or ``delta`` (delta-packed integers), the size of
a row group and the rows of a page.  Files carry column and offset indexes, so a
read of some documents (``read_tokens`` with a range of doc_id) or of the
metadata alone touches few pages.

``part`` is the range partition and ``start_in_part`` the ids before the
document in it; the global start adds the totals of earlier parts, one row a
part.

Defined cases: null text is the end id alone; documents with a null doc_id come
first; repeated rows get a row each, in a fixed order; an empty table gives an
empty file; other input columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text
from shoplens.llm.tokens import encode_column

END_ID = 2
BATCH_ROWS = 1000
_ROW = "doc_id bigint, n_tokens bigint, part int, start_in_part bigint, tokens array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            row = 0
            for ids, off in encode_column(batch.column(1), path, False, end_id):
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, n), pa.array(np.diff(off)), pa.array(np.full(n, part, np.int32)),
                    pa.array(off[:-1] + before), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["doc_id", "n_tokens", "part", "start_in_part", "tokens"])
                before += int(off[-1])
                row += n
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, encoding: str = "dictionary",
                 row_group_bytes: int = 16 << 20, page_rows: int = 500) -> None:
    """Writes the documents' ids to ``path`` in ascending doc_id order."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is 'dictionary' or 'delta'")
    # Rows of one doc_id are split by text, equal rows by their place in the input: no id is one task's alone.
    keyed = keys_and_text(docs).withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    rows = ordered.mapInArrow(_encode(tokenizer_path, end_id), _ROW)
    # Smaller batches than the default 10,000 rows: a worker holds a few MB of text at a time.
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(min(int(before), BATCH_ROWS)))
    try:
        _write(rows, path, encoding, row_group_bytes, page_rows)
    finally:
        conf.set(key, before)


def _write(rows: DataFrame, path: str, encoding: str, row_group_bytes: int, page_rows: int) -> None:
    (rows.write.option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("compression", "zstd")
     .parquet(path))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                columns: tuple[str, ...] = ("doc_id", "n_tokens", "part", "start_in_part", "tokens")) -> DataFrame:
    """The written rows, or those of doc_id ``first`` to ``last``, with the asked columns only."""
    rows = spark.read.schema(_ROW).parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows.select(*columns)


def _checksums(batches):
    for batch in batches:
        tokens = batch.column(3)
        off = tokens.offsets.to_numpy()
        data = memoryview(np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False), "<i4").tobytes())
        crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(off).astype(np.int64)),
                                          pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start over all documents, n_tokens, ids_crc32."""
    totals = read_tokens(spark, path, columns=("part", "n_tokens")).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row a written partition, so the running sum is over a few thousand rows at most.
    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(running), F.lit(0)).alias("base"))
    rows = read_tokens(spark, path, columns=("doc_id", "part", "start_in_part", "tokens")).mapInArrow(
        _checksums, "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, "part").select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def token_files_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = Staging(spark, "tokens").path("files")
    write_tokens(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_digests(spark, path)
