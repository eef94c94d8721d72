"""Token-ID output: Parquet files of token lists, and reading them back selectively.

A file row is one document: its id, its shard, where its tokens start inside the shard, how many
there are, and the list of ids. Rows are in ascending order of id over the shards, and
sorted inside each, so statistics of pages and row groups (which the writer puts into the page
index) let a reader skip to a range of ids or read the numbers without any token page.
Token lists are dictionary-encoded where a vocabulary is small against a page, else
delta-encoded; the size of row groups and pages is set, not left to defaults.

Defined results: a NULL or empty text is a document with the end id alone; documents that
repeat an id stay, in the order of their text; documents without an id come first; no rows give
files without rows. Texts of any length are worked on whole, a few megabytes of
documents at a time. Other columns of the documents are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelftide.llm.common import id_and_text, text_slices
from shelftide.llm.word_cache import cached_encoder

FILE_SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, tokens array<int>"


@dataclass(frozen=True)
class FileLayout:
    """Sizes in bytes. ``dictionary`` False gives delta encoding (format version 2)."""

    row_group: int = 32 << 20
    page: int = 256 << 10
    dictionary: bool = True
    dictionary_page: int = 2 << 20
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "compression": self.codec,
            "parquet.block.size": str(self.row_group),
            "parquet.page.size": str(self.page),
            "parquet.dictionary.page.size": str(self.dictionary_page),
            "parquet.enable.dictionary": str(self.dictionary).lower(),
            "parquet.writer.version": "v1" if self.dictionary else "v2",
        }


def encode_documents(
    docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None
) -> DataFrame:
    """Documents as rows of the file format, in ascending order of id over the shards.

    The texts are dealt by ranges of ids, and of a hash of the text where ids repeat, and encoded
    where they land; tokens are never shuffled. ``shards`` is the number of files to come, by default
    the session's shuffle partitions: choose it so that a shard holds some 100 MB of text.
    """
    frame = id_and_text(docs, id_col, text_col)
    count = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = frame.repartitionByRange(count, "doc_id", F.xxhash64("data")).sortWithinPartitions("doc_id", F.xxhash64("data"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, start = cached_encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text_slices(batch):
                ids, sizes = encoder.encode_texts(part.column("data").to_pylist(), end_id)
                ends = np.cumsum(sizes)
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                tokens = pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32)))
                starts = start + ends - sizes
                start += int(ends[-1]) if len(ends) else 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.full(len(sizes), shard, np.int32)),
                        pa.array(starts),
                        pa.array(sizes),
                        tokens,
                    ],
                    ["doc_id", "shard", "shard_start", "n_tokens", "tokens"],
                )

    return sorted_rows.mapInArrow(encode, FILE_SCHEMA)


def write_tokens(rows: DataFrame, path: str, layout: FileLayout = FileLayout()) -> str:
    rows.write.options(**layout.options()).parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, where: Column | None = None, tokens: bool = True) -> DataFrame:
    """Rows of the files with ``start``, the number of tokens of all documents before. The start
    of each shard comes from the number columns alone: one row per shard."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = rows.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    # A shard is one task of the writer, so the window runs over as many rows as it had tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("base"))
    if where is not None:
        rows = rows.where(where)
    joined = rows.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("shard_start"))
    kept = ["doc_id", "start", "n_tokens", *(["tokens"] if tokens else [])]
    return joined.select(*kept)


def with_checksums(rows: DataFrame, checksum: Callable[[bytes], int] = zlib.crc32) -> DataFrame:
    """doc_id, start, n_tokens as the lists have them, and the checksum of each list."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            values = np.asarray(lists.flatten()).astype("<u4", copy=False)
            lengths = np.diff(np.asarray(lists.offsets))
            ends = np.cumsum(lengths)
            crcs = [checksum(memoryview(values[e - n : e])) for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(lengths.astype(np.int64)), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.select("doc_id", "start", "tokens").mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")
