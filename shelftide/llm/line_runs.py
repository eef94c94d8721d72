"""Line dedup: repeated runs of lines by a suffix array over line-ID sequences.

Every document is a sequence of line ids. Its suffixes are sorted by prefix doubling: level 0
ranks single lines, level k+1 ranks runs of 2^(k+1) lines by the pair of ranks (run at a line, run
2^k lines on). Ranks come from a range-partitioned sort of the distinct pairs, so no task holds
all suffixes and a line that a third of all documents share is one row of that sort. A suffix
whose prefix is unique lies in no interval of common prefixes and leaves; runs end with
their document, so none crosses a border.

A run counts if it has ``min_words`` words or more. For a line, the shortest such run that starts there
has some number of lines between 2^k and 2^(k+1); two overlapping ranks of level k name it
exactly. Suffixes of one name are an interval of the suffix array whose longest common prefix has
at least that length. In each interval the first occurrence (by doc_id, then line) stays and the
lines of the others are deleted; overlapping runs unite to the maximal repeated run. Every deleted
line thus still stands where its run came first.

Doubling goes on only while some repeated run is still shorter than ``min_words``.

Defined results: a NULL text stays NULL; an empty line counts as a line without words; runs
repeated inside one document count too. Rows that repeat both doc_id and text are one document and
are treated alike; rows that share a doc_id only are ordered by a hash of the text. Documents
without doc_id come first; no rows give no rows. Texts of any length are cut whole, a few megabytes of documents at a time. Other
columns stay as they are; one that has the name of a count column gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import Scratch, key_filter, lean, map_slices, may_hold, text_slices, unused_name

MIN_WORDS = 50
_NO_ID = -(1 << 63)


def _doc(id_column: Column) -> Column:
    return F.coalesce(id_column.cast("long"), F.lit(_NO_ID))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """One row per line: document, line number, 128 bits of the line, and how many lines from here
    have ``min_words`` words (0: fewer are left)."""
    source = docs.select(
        _doc(F.col(id_col)).alias("doc"), F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("data")
    )

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        owner, number, high, low, need = [], [], [], [], []
        for k, data in enumerate(part.column("data").to_pylist()):
            if data is None:
                continue
            lines = data.split(b"\n")
            total = np.cumsum([len(x.split()) for x in lines])
            before = np.concatenate([[0], total[:-1]])
            last = np.searchsorted(total, before + min_words)
            need.append(np.where(last < len(lines), last - np.arange(len(lines)) + 1, 0))
            number.append(np.arange(len(lines)))
            owner.append(np.full(len(lines), k))
            digests = b"".join(map(xxhash.xxh3_128_digest, lines))
            both = np.frombuffer(digests, "<i8").reshape(-1, 2)
            high.append(both[:, 0])
            low.append(both[:, 1])
        joined = lambda x, kind: pa.array(np.concatenate(x) if x else np.empty(0), kind, safe=False)
        owners = joined(owner, pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc").take(owners),
                part.column("tie").take(owners),
                joined(number, pa.int32()),
                joined(high, pa.int64()),
                joined(low, pa.int64()),
                joined(need, pa.int32()),
            ],
            ["doc", "tie", "line", "a", "b", "need"],
        )

    return map_slices(source, work, "doc long, tie long, line int, a long, b long, need int")


def _ranked(pairs: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """Rows of staged pairs (a, b) that occur more than once, with the rank of the pair. The rank numbers
    the sorted distinct pairs: partitions are ranges in order, so the running row ids ascend with
    the pairs. Staged at once, since a second run might cut other ranges. The pairs are deleted."""
    repeated = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b")
    ranks = repeated.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("rank", F.monotonically_increasing_id())
    ranks = scratch.stage(ranks, f"{name}_ranks")
    ranked = scratch.stage(pairs.join(ranks, ["a", "b"]).select("doc", "tie", "line", "need", "rank"), name)
    scratch.drop(pairs, ranks)
    return ranked


def _shifted(ranked: DataFrame, by: Column) -> DataFrame:
    """Each row with the rank ``by`` lines on, if that one is repeated as well."""
    ahead = ranked.select("doc", "tie", F.col("line").alias("at"), F.col("rank").alias("b"))
    here = ranked.select("doc", "tie", "line", "need", F.col("rank").alias("a"), (F.col("line") + by).alias("at"))
    return here.join(ahead, ["doc", "tie", "at"])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, tie, spans): for each document with later copies, the line spans (start, lines)."""
    scratch = Scratch(docs.sparkSession, "line_runs")
    # Rows that repeat doc_id and text have the same lines at the same places: each is kept once. Only
    # documents with several rows are shuffled for that.
    several = docs.groupBy(_doc(F.col(id_col)).alias("doc"), F.xxhash64(text_col).alias("tie")).agg(F.count(F.lit(1)).alias("n"))
    several = scratch.stage(several.where("n > 1").select("doc", "tie"), "several")
    lines = _lines(docs, id_col, text_col, min_words)
    once = lines.join(several, ["doc", "tie"], "left_semi").dropDuplicates(["doc", "tie", "line"])
    lines = scratch.stage(lines.join(several, ["doc", "tie"], "left_anti").unionByName(once), "lines")
    ranked = _ranked(lines, "level_0", scratch)
    level, named = 0, None
    while True:
        size = 1 << level
        ready = ranked.where(F.col("need").between(size, 2 * size - 1))
        # The later half of the run may start at any repeated line.
        ahead = ranked.select("doc", "tie", F.col("line").alias("at"), F.col("rank").alias("b"))
        runs = ready.withColumn("at", F.col("line") + F.col("need") - size).join(ahead, ["doc", "tie", "at"])
        runs = scratch.stage(runs.select("doc", "tie", "line", "need", F.col("rank").alias("a"), "b"), "runs")
        named = runs if named is None else named.unionByName(runs)
        if ranked.where(F.col("need") >= 2 * size).isEmpty():
            break
        level += 1
        pairs = scratch.stage(_shifted(ranked, F.lit(size)).select("doc", "tie", "line", "need", "a", "b"), f"pairs_{level}")
        scratch.drop(ranked)
        ranked = _ranked(pairs, f"level_{level}", scratch)
    place = F.struct("doc", "tie", "line")
    interval = ["need", "a", "b"]
    # Which lines a name stands for depends on its length too: levels differ by ``need``.
    first = named.groupBy(*interval).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
    first = scratch.stage(first.select(*interval, "first"), "first_places")
    later = named.join(first, interval).where(place > F.col("first"))
    spans = F.collect_list(F.struct(F.col("line").alias("start"), F.col("need").alias("lines"))).alias("spans")
    return scratch.finish(later.groupBy("doc", "tie").agg(spans))


def delete_repeated_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    counts: tuple[str, str] | None = None,
    drop_emptied: bool = False,
) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from ``text_col``.

    ``counts`` names two long columns to add, the number of lines and of deleted lines (0 for
    NULL). ``drop_emptied`` removes a document that had words and has none left.
    """
    names = {c: unused_name(docs.columns, c) for c in ("run_doc", "run_tie", "run_spans", "n_lines", "n_deleted", "emptied")}
    spans = repeated_spans(docs, id_col, text_col, min_words)
    passes = key_filter(spans.select(F.xxhash64("doc", "tie").alias("code")))
    passes = Scratch(docs.sparkSession, "line_filter").finish(passes)
    spans = spans.select(F.col("doc").alias(names["run_doc"]), F.col("tie").alias(names["run_tie"]), F.col("spans").alias(names["run_spans"]))
    keyed = docs.withColumn(text_col, F.col(text_col).cast("string"))
    doc, tie = _doc(F.col(id_col)), F.xxhash64(F.col(text_col))
    # Only texts with a deleted line (and the few that the filter lets through besides) are shuffled to meet their
    # spans; all others stay where they are.
    touched = may_hold(passes, F.xxhash64(doc, tie))
    zero = F.lit(0).cast("long")
    count = F.when(F.col(text_col).isNull(), zero).otherwise((F.length(text_col) - F.length(F.replace(text_col, F.lit("\n"), F.lit(""))) + 1).cast("long"))
    others = keyed.where(~touched).withColumn(names["n_lines"], count).withColumn(names["n_deleted"], zero).withColumn(names["emptied"], F.lit(False))
    match = (doc == spans[names["run_doc"]]) & (tie == spans[names["run_tie"]])
    joined = keyed.where(touched).join(spans, match, "left").drop(names["run_doc"], names["run_tie"])
    joined = joined.withColumn(text_col, F.col(text_col).cast("binary"))
    wanted = joined.drop(names["run_spans"]).schema
    for c, kind in ((names["n_lines"], "long"), (names["n_deleted"], "long"), (names["emptied"], "boolean")):
        wanted = wanted.add(c, kind)
    text, held = text_col, names["run_spans"]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text):
                texts, counts, deleted, emptied = part.column(text).to_pylist(), [], [], []
                for k, (data, spans) in enumerate(zip(texts, part.column(held).to_pylist(), strict=True)):
                    n = 0 if data is None else data.count(b"\n") + 1
                    gone = 0
                    if spans:
                        texts[k], gone = without_lines(data, [(s["start"], s["lines"]) for s in spans])
                    counts.append(n)
                    deleted.append(gone)
                    emptied.append(bool(gone) and not texts[k].split())
                names = [c for c in part.schema.names if c != held]
                arrays = [part.column(c) for c in names]
                arrays[names.index(text)] = pa.array(texts, part.column(text).type)
                added = [pa.array(counts, pa.int64()), pa.array(deleted, pa.int64()), pa.array(emptied, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*arrays, *added], wanted.names)

    out = joined.mapInArrow(lean(rewrite), wanted).withColumn(text_col, F.col(text_col).cast("string")).unionByName(others)
    if drop_emptied:
        out = out.where(~F.col(names["emptied"]))
    extra = [F.col(names[c]).alias(n) for c, n in zip(("n_lines", "n_deleted"), counts, strict=True)] if counts else []
    # A column of the input that has the name of a count gives way to it.
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in counts or ()}]
    return out.select(*kept, *extra)


def without_lines(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The text without the lines of the spans, and how many those were."""
    lines = data.split(b"\n")
    change = np.zeros(len(lines) + 1, np.int64)
    for start, count in spans:
        change[start] += 1
        change[start + count] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return b"\n".join([x for x, g in zip(lines, gone.tolist(), strict=True) if not g]), int(gone.sum())
