"""What the document operators share: tables, staging, text batches, word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.sources.shared import fresh_path

# Bytes of text that a task turns into words at a time.
SLICE_BYTES = 2 << 20

# The columns of the tables that the queries read.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again. A lost executor recomputes nothing before
    it, and later joins see a plain scan, whose skewed keys adaptive execution can split."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one operator stages for itself. ``drop`` deletes those that nothing reads any more, ``finish`` writes
    the result and deletes all others, so that the shared folder does not fill up."""

    def __init__(self, session: SparkSession, name: str) -> None:
        self.session, self.folder, self.count = session, fresh_path(session, name), 0
        self.held: list[tuple[DataFrame, str]] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/work/{self.count:03d}_{name}"
        df.write.parquet(path)
        staged = self.session.read.schema(df.schema).parquet(path)
        self.held.append((staged, path))
        return staged

    def _delete(self, path: str) -> None:
        work = self.session._jvm.org.apache.hadoop.fs.Path(path)
        work.getFileSystem(self.session._jsc.hadoopConfiguration()).delete(work, True)

    def drop(self, *frames: DataFrame) -> None:
        """Deletes staged frames. Call it only when all that was computed from them is staged itself."""
        for frame, path in self.held:
            if any(frame is f for f in frames):
                self._delete(path)
        self.held = [h for h in self.held if not any(h[0] is f for f in frames)]

    def finish(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/result"
        df.write.parquet(path)
        self._delete(f"{self.folder}/work")
        return self.session.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that an operator needs, as ``doc_id`` and UTF-8 bytes ``data``."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("data"))


def text_slices(batch: pa.RecordBatch, column: str = "data", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of text, one row at least, so
    that the words of a batch of long documents are never in memory together."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for row, length in enumerate(lengths):
        if row > start and total + length > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield batch.slice(start)


# What an operator keeps in a worker process from task to task, such as a codec with its store of words.
_HELD: dict[str, object] = {}


def held_by_worker(key: str, make: Callable[[], object]) -> object:
    """``make()``, kept for the next tasks of this operator. A worker process keeps one such thing."""
    if key not in _HELD:
        release_held()
        _HELD[key] = make()
    return _HELD[key]


def release_held() -> None:
    """Workers serve the tasks of all operators in turn, so a task that keeps nothing first gives back what an
    earlier operator kept; else that would stand beside its own memory."""
    if not _HELD:
        return
    _HELD.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, whose freed memory is given back when a task is through. Allocators keep it otherwise, so that
    every idle worker of an executor would hold what its largest task needed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, keeps: bool = False) -> DataFrame:
    """``work`` on each slice of texts of each task. ``keeps``: it uses ``held_by_worker``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release_held()
        for batch in batches:
            for part in text_slices(batch):
                yield work(part)

    return df.mapInArrow(lean(run), schema)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (a multiply-xorshift finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size`` consecutive word hashes."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    found = np.zeros(count, np.uint64)
    for k in range(size):
        found *= np.uint64(0x9E3779B97F4A7C15)
        found += words[k : k + count]
    return mix(found)


# Bits of a key filter: 1 MB, however many keys there are.
FILTER_BITS = 23


def key_filter(codes: DataFrame) -> DataFrame:
    """A Bloom filter (two bits a key) of the 64-bit hashes in column ``code``, as one row ``words``. Its size is fixed; with
    very many keys it lets everything pass, and what is decided behind it stays right."""
    size = 1 << (FILTER_BITS - 6)
    mask = (1 << FILTER_BITS) - 1
    marks = codes.select(F.expr(f"explode(array(code & {mask}L, shiftrightunsigned(code, 32) & {mask}L)) AS at"))
    marks = marks.select(F.expr("CAST(shiftright(at, 6) AS INT) AS word"), F.expr("shiftleft(1L, CAST(at & 63 AS INT)) AS bits"))
    empty = codes.sparkSession.range(size).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = marks.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # One row per word of the filter, a fixed number.
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("words"))


def may_hold(filter_row: DataFrame, code: Column) -> Column:
    """False for hashes that the filter does not hold. A scalar subquery: no row carries the filter."""
    words, mask = filter_row.scalar(), F.lit((1 << FILTER_BITS) - 1).cast("long")

    def bit(at: Column) -> Column:
        word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
        return F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1

    return bit(code.bitwiseAND(mask)) & bit(F.shiftrightunsigned(code, 32).bitwiseAND(mask))


def unused_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column (in any case) has that name."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted


def row_key(id_column: Column, text_column: Column) -> Column:
    """128 bits that name a row by id and text. Rows that repeat both are one document."""
    known = F.coalesce(id_column.cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", known, F.coalesce(F.md5(text_column.cast("binary")), F.lit("null"))))
