"""Benchmark decontamination: a broadcast hash set of test n-grams against training windows.

Words are runs of ASCII letters and digits (lower-cased) and characters beyond ASCII. An
item gives every window of ``size`` consecutive words; an item of fewer words, but not
none, is one window. Every window of every document is looked up by hash in the set of the
items' windows, a match is confirmed on the words themselves, and all its words are hit.

The items are a stated query set. Their windows are broadcast in blocks of at most
``block_bytes`` of item text; with more items than one block holds, the documents are scanned
once for each block, one block after the other, and the spans of a document are merged afterwards, so what the
driver and the tasks hold never grows beyond the bound. The results do not depend on the blocks: texts are cut by the
spans of all blocks at once, and scanned again until no block has a hit.

Defined results: a NULL or empty text has no words and no hits; a NULL item text has no
windows; items with equal texts are found together; repeated documents each get their own
row; items without an id are listed together under the name null; without items, or without documents, nothing is hit.
Texts of any length are scanned whole, a few megabytes of documents at a time. Other columns of the documents, whatever
their names, stay as they are.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import Scratch, hash_words, key_filter, lean, map_slices, may_hold, row_key, text_slices, unused_name, window_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20
# Bits of a window hash that a quick look-up table sees before the search.
_SIEVE_BITS = 20

# ASCII: letters become lower case, digits stay, all else separates words. Bytes of
# characters beyond ASCII stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_FOLD).split() if data else []


class WindowIndex:
    """Windows of benchmark items: hashes for the scan, words to confirm a match. Windows of
    a full size and of each smaller size (short items) are kept apart."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], size: int) -> None:
        holders: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, data in items:
            words = words_of(data)
            n = min(size, len(words))
            for k in range(len(words) - n + 1 if n else 0):
                holders[n][tuple(words[k : k + n])].add("null" if item is None else str(item))
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, dict[int, list]]] = {}
        for n, windows in holders.items():
            confirm: dict[int, list] = defaultdict(list)
            for words, names in windows.items():
                confirm[int(window_hashes(hash_words(list(words)), n)[0])].append((words, frozenset(names)))
            known = np.array(sorted(confirm), np.uint64)
            seen = np.zeros(1 << _SIEVE_BITS, bool)
            seen[known >> np.uint64(64 - _SIEVE_BITS)] = True
            self.by_size[n] = known, seen, dict(confirm)

    def hits(self, texts: list[list[bytes]]) -> list[list[tuple[int, int, frozenset]]]:
        """For each document (given as its words) the (start, end, items) of every window
        that an item holds. The windows of all documents are hashed together."""
        found: list[list[tuple[int, int, frozenset]]] = [[] for _ in texts]
        words = [w for t in texts for w in t]
        ends = np.cumsum([len(t) for t in texts])
        hashes = hash_words(words)
        for n, (known, seen, confirm) in self.by_size.items():
            windows = window_hashes(hashes, n)
            maybe = np.flatnonzero(seen[windows >> np.uint64(64 - _SIEVE_BITS)])
            if not len(maybe):
                continue
            at = np.minimum(np.searchsorted(known, windows[maybe]), len(known) - 1)
            maybe = maybe[known[at] == windows[maybe]]
            for k, doc in zip(maybe.tolist(), np.searchsorted(ends, maybe, side="right").tolist(), strict=True):
                if k + n <= ends[doc]:
                    here, first = tuple(words[k : k + n]), int(ends[doc]) - len(texts[doc])
                    found[doc] += [(k - first, k - first + n, items) for t, items in confirm[int(windows[k])] if t == here]
        return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words without overlap, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ITEMS = pa.list_(pa.string())


def _block_count(benchmark: DataFrame, text_col: str, block_bytes: int) -> int:
    """Blocks hold half the bound on average, since items are dealt by hash."""
    total = benchmark.agg(F.sum(F.length(F.col(text_col).cast("binary")))).first()[0] or 0
    return max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1


def _index(benchmark: DataFrame, item_col: str, text_col: str, count: int, block: int, size: int) -> Broadcast:
    """The windows of one block's items; only these items come to the driver."""
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("binary").alias("data"))
    part = items.where(F.pmod(F.xxhash64("item_id", "data"), F.lit(count)) == block).collect()
    held = [(r["item_id"], bytes(r["data"]) if r["data"] is not None else None) for r in part]
    return benchmark.sparkSession.sparkContext.broadcast(WindowIndex(held, size))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``spans`` are the hit word ranges, merged. ``items_sha256`` digests the sorted ids of the items found.
    """
    frame = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("data"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, spans array<struct<start:int,end:int>>, held array<string>"

    def scanner(index: Broadcast) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [words_of(data) for data in batch.column("data").to_pylist()]
            counts, spans, held = [len(words) for words in texts], [], []
            for hits in index.value.hits(texts):
                spans.append([{"start": a, "end": b} for a, b in _merged([h[:2] for h in hits])])
                held.append(sorted({name for h in hits for name in h[2]}))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(held, _ITEMS)],
                ["doc_id", "n_words", "spans", "held"],
            )

        return scan

    count = _block_count(benchmark, item_text_col, block_bytes)
    if count == 1:
        return _summary(map_slices(frame, scanner(_index(benchmark, item_col, item_text_col, 1, 0, size)), schema))
    scratch, parts = Scratch(docs.sparkSession, "contamination"), []
    keyed = frame.withColumn("row", row_key(F.col("doc_id"), F.col("data")))
    for block in range(count):
        index = _index(benchmark, item_col, item_text_col, count, block, size)
        # Staged at once: the next block comes only when this one is done with.
        parts.append(scratch.stage(_with_row(keyed, scanner(index), f"{schema}, row string"), f"block_{block}"))
        index.destroy()
    return _summary(_joined(parts))


def _with_row(source: DataFrame, scan, schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out = scan(part)
                yield pa.RecordBatch.from_arrays([*out.columns, part.column("row")], [*out.schema.names, "row"])

    return source.mapInArrow(lean(work), schema)


def _joined(parts: list[DataFrame]) -> DataFrame:
    """The results of several blocks, united per document. A repeated row appears once per block and copy, so copies are counted by block."""
    tagged = [p.withColumn("block", F.lit(k)) for k, p in enumerate(parts)]
    united = tagged[0]
    for other in tagged[1:]:
        united = united.unionByName(other)
    grouped = united.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("held"))).alias("held"),
        F.sum(F.when(F.col("block") == 0, 1).otherwise(0)).alias("copies"),
    )
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy", "copies", "row")


def _summary(found: DataFrame) -> DataFrame:
    # Spans are merged in Python within a block; across blocks they may overlap still, so
    # the covered words are counted from the highest end so far.
    step = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
    )
    out = found.withColumn("n_hit", step["n"])
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("held").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("held"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    max_hit_share: float = 0.5,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents without benchmark text, all columns kept.

    Hit words, with what stands between them, are cut out of the text; a document of
    which more than ``max_hit_share`` of the words are hit is removed. Documents without a hit are
    returned unchanged, byte for byte.
    """
    columns = docs.columns
    text = unused_name(columns, "new_text")
    keep = unused_name([*columns, text], "share_left")
    out = docs.withColumn(text, F.col(text_col).cast("binary")).withColumn(keep, F.lit(1.0))
    count = _block_count(benchmark, "text", block_bytes)
    if count == 1:
        out = _cut_in_place(out, _index(benchmark, "item_id", "text", 1, 0, size), text, keep)
    else:
        out = _cut_by_rounds(out, benchmark, count, size, id_col, text, keep)
    left = out.where(F.col(keep) >= 1.0 - max_hit_share)
    return left.withColumn(text_col, F.col(text).cast("string")).select(*columns)


def _cut_in_place(docs: DataFrame, index: Broadcast, text: str, keep: str) -> DataFrame:
    """One narrow pass, without a shuffle: spans are cut where they are found, and again where the words around
    a cut form a window, until none is left."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                texts, shares = part.column(text).to_pylist(), part.column(keep).to_pylist()
                split = [words_of(data) for data in texts]
                for k, hits in enumerate(index.value.hits(split)):
                    words = split[k]
                    while hits:
                        texts[k], left = cut_spans(texts[k], words, _merged([h[:2] for h in hits]))
                        shares[k] *= left
                        words = words_of(texts[k])
                        hits = index.value.hits([words])[0]
                yield _with_columns(part, {text: texts, keep: shares})

    return docs.mapInArrow(lean(cut), docs.schema)


def _with_columns(part: pa.RecordBatch, new: dict[str, list]) -> pa.RecordBatch:
    arrays = [pa.array(new[n], part.schema.field(n).type) if n in new else part.column(n) for n in part.schema.names]
    return pa.RecordBatch.from_arrays(arrays, part.schema.names)


def _cut_by_rounds(docs: DataFrame, benchmark: DataFrame, count: int, size: int, id_col: str, text: str, keep: str) -> DataFrame:
    """The same for items of several blocks. A round takes the spans of every block, staged one after the other, and
    then cuts each text once by all of them; only texts that were cut are looked at again. Few texts are cut, and a
    key filter picks them out, so the others are not shuffled."""
    scratch, done = Scratch(docs.sparkSession, "cuts"), []
    row, held = (unused_name(docs.columns, n) for n in ("row", "cut_spans"))
    looked_at = docs.withColumn(row, row_key(F.col(id_col), F.col(text)))

    def finder(index: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch, "data"):
                    hits = index.value.hits([words_of(data) for data in part.column("data").to_pylist()])
                    spans = [[{"start": a, "end": b} for a, b in _merged([h[:2] for h in found])] for found in hits]
                    rows = pa.RecordBatch.from_arrays([part.column("row"), pa.array(spans, _SPANS)], ["row", "spans"])
                    yield rows.filter(pa.array([bool(s) for s in spans], pa.bool_()))

        return find

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                texts, shares = part.column(text).to_pylist(), part.column(keep).to_pylist()
                for k, spans in enumerate(part.column(held).to_pylist()):
                    texts[k], left = cut_spans(texts[k], words_of(texts[k]), _merged([(s["start"], s["end"]) for s in spans]))
                    shares[k] *= left
                rows = _with_columns(part, {text: texts, keep: shares})
                yield rows.select([n for n in rows.schema.names if n != held])

    while True:
        seen, parts = looked_at.select(F.col(row).alias("row"), F.col(text).alias("data")), None
        for block in range(count):
            index = _index(benchmark, "item_id", "text", count, block, size)
            found = scratch.stage(seen.mapInArrow(lean(finder(index)), "row string, spans array<struct<start:int,end:int>>"), f"block_{block}")
            index.destroy()
            parts = found if parts is None else parts.unionByName(found)
        # Rows that repeat id and text have the same spans; a text has at most as many as words.
        spans = scratch.stage(parts.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_set("spans"))).alias("spans")), "spans")
        if spans.isEmpty():
            done.append(looked_at.drop(row))
            break
        passes = scratch.stage(key_filter(spans.select(F.xxhash64("row").alias("code"))), "filter")
        named = spans.select(F.col("row").alias(row), F.col("spans").alias(held))
        maybe, sure = looked_at.where(may_hold(passes, F.xxhash64(row))), looked_at.where(~may_hold(passes, F.xxhash64(row)))
        done += [sure.drop(row), maybe.join(named, row, "left_anti").select(*looked_at.columns).drop(row)]
        hit = maybe.join(named, row).select(*looked_at.columns, held)
        looked_at = scratch.stage(hit.mapInArrow(lean(cut), looked_at.schema), "cut")
    out = done[0]
    for rows in done[1:]:
        out = out.unionByName(rows)
    return scratch.finish(out)


def cut_spans(data: bytes, words: list[bytes], spans: list[tuple[int, int]]) -> tuple[bytes, float]:
    """The text without the words of ``spans``, and the share of words that stay. Each cut
    becomes one line break."""
    folded, at, places = data.translate(_FOLD), 0, []
    for word in words:
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    pieces, last = [], 0
    for start, end in spans:
        pieces.append(data[last : places[start][0]])
        last = places[end - 1][1]
    pieces.append(data[last:])
    hit = sum(end - start for start, end in spans)
    return b"\n".join(pieces), 1.0 - hit / len(words)
