"""Quality rules from tokeniser fertility.

Words are cut at ASCII white space. Each is encoded alone with public vocabularies, which gives
per document and vocabulary: characters per token, the share of byte-fallback tokens, and the
entropy of the token distribution. For each language the middle half of the documents
sets bands; a document outside is rejected:

* characters per token below or above its band (text the vocabulary breaks up, or hardly any),
* byte-fallback share above its band,
* entropy below its band, both in bits and relative to the length (repetition).

Plain counts (``base``) come first: too few words, or too many words in repeated windows.

Bands come from all documents that pass the base rules: quartiles by language, aggregated
before the shuffle. A language of fewer than ``least_documents`` takes the bands of all documents.

Defined results: a NULL or wordless text has zero counts and fails the base rule; documents without a
language are one group; repeated rows each get a row; no rows give no rows. Texts of any length are worked on whole, a few megabytes of
documents at a time. Other columns of
the documents, whatever their names, are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import map_slices, mix, stage, window_hashes

WINDOW = 8
LEAST_WORDS = 20
REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
TABLE_WORDS = 250_000
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Vocabulary:
    """A public vocabulary file: ``kind`` is piece (SentencePiece) or ranks (tiktoken)."""

    name: str
    kind: str
    path: str
    pattern: str = ""


@dataclass(frozen=True)
class BandParams:
    """Bands reach ``reach`` times the spread of the middle half beyond it; the spreads have
    floors, since a group may be very even."""

    reach: float = 4.0
    chars_floor: float = 0.1
    bytes_floor: float = 0.01
    entropy_floor: float = 0.5
    relative_floor: float = 0.02
    least_documents: int = 50


class _Encoder:
    """Token ids of single words, many at a time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        if vocabulary.kind == "piece":
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary.path)
            self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
            self.encode = lambda words: self.model.encode(words, num_threads=1)
        else:
            import tiktoken

            with open(vocabulary.path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            model = tiktoken.Encoding(vocabulary.name, pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
            # A token that is a part of a character stands for a byte, as in byte fallback.
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            for text, number in ranks.items():
                try:
                    text.decode()
                except UnicodeDecodeError:
                    self.is_byte[number] = True
            self.encode = lambda words: [model.encode_ordinary(" " + w) for w in words]


class _WordTable:
    """Words seen by a task, their characters, and their ids per vocabulary. Forgotten when
    full, so memory stays bounded."""

    def __init__(self, vocabularies: Sequence[Vocabulary]) -> None:
        self.encoders = [_Encoder(v) for v in vocabularies]
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.chars = np.empty(0, np.int64)
        self.flat = [np.empty(0, np.int64) for _ in self.encoders]
        self.starts = [np.zeros(1, np.int64) for _ in self.encoders]

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.index) > TABLE_WORDS:
            self.clear()
        fresh = list(set(words).difference(self.index))
        if fresh:
            texts = [w.decode() for w in fresh]
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh)), strict=True))
            self.chars = np.concatenate([self.chars, [len(t) for t in texts]])
            for k, encoder in enumerate(self.encoders):
                coded = encoder.encode(texts)
                self.flat[k] = np.concatenate([self.flat[k], *[np.array(c, np.int64) for c in coded]])
                self.starts[k] = np.concatenate([self.starts[k], self.starts[k][-1] + np.cumsum([len(c) for c in coded])])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def tokens(self, k: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens each word has, and the ids of all in order."""
        starts = self.starts[k][numbers]
        sizes = self.starts[k][numbers + 1] - starts
        ends = np.cumsum(sizes)
        at = np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return sizes, self.flat[k][at]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums between neighbouring bounds, empty ranges included."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def repeated_words(words: np.ndarray, bounds: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Per document, the words in a window of ``size`` words that is found twice or more in it.
    ``words`` are word numbers of all documents, one after the other."""
    windows = window_hashes(mix(words.astype(np.uint64) + np.uint64(1)), size)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    covered = np.zeros(len(words) + 1, np.int64)
    if len(windows):
        inside = np.flatnonzero(doc[: len(windows)] == doc[size - 1 :])
        keys = windows[inside] ^ mix(doc[inside].astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        order = np.argsort(keys)
        equal = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        starts = inside[twice]
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + size, -1)
    return _sums(np.cumsum(covered[:-1]) > 0, bounds)


def entropies(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of the distribution of ids between neighbouring bounds."""
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    keys = np.sort((doc.astype(np.int64) << 20) | ids)
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.concatenate([new, [len(keys)]]))
    parts = np.bincount(keys[new] >> 20, weights=counts * np.log2(counts), minlength=len(sizes)) if len(keys) else np.zeros(len(sizes))
    return np.where(sizes > 0, np.log2(np.maximum(sizes, 1)) - parts / np.maximum(sizes, 1), 0.0)


_TABLES: dict[tuple[Vocabulary, ...], _WordTable] = {}


def measure(
    docs: DataFrame, vocabularies: Sequence[Vocabulary], id_col: str = "doc_id", text_col: str = "text", group_col: str | None = "lang"
) -> DataFrame:
    """One row per document: the base counts, and tokens, byte tokens and entropy per vocabulary."""
    wanted = tuple(vocabularies)
    group: Column = F.coalesce(F.col(group_col).cast("string"), F.lit("")) if group_col else F.lit("")
    source = docs.select(F.col(id_col).alias("doc_id"), group.alias("band_group"), F.col(text_col).cast("binary").alias("data"))
    kind = source.schema["doc_id"].dataType.simpleString()
    measured = [f"{v.name}_{m}" for v in wanted for m in ("tokens", "bytes", "entropy")]

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        if wanted not in _TABLES:
            _TABLES[wanted] = _WordTable(wanted)
        table = _TABLES[wanted]
        texts = [x or b"" for x in part.column("data").to_pylist()]
        split = [x.split() for x in texts]
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
        numbers = table.numbers([w for words in split for w in words])
        worded = [[x for x in text.split(b"\n") if x and not x.isspace()] for text in texts]
        columns = [
            np.diff(bounds),
            _sums(table.chars[numbers], bounds),
            np.array([len(x) - len(x.translate(None, SYMBOLS)) for x in texts], np.int64),
            np.array([len(x) - len(set(x)) for x in worded], np.int64),
            repeated_words(numbers, bounds),
        ]
        for k, encoder in enumerate(table.encoders):
            sizes, ids = table.tokens(k, numbers)
            counts = _sums(sizes, bounds)
            token_bounds = np.concatenate([[0], np.cumsum(counts)])
            columns += [counts, _sums(encoder.is_byte[ids], token_bounds), entropies(ids, token_bounds)]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("band_group"), *map(pa.array, columns)], ["doc_id", "band_group", *_BASE, *measured]
        )

    types = ", ".join(f"{c} {'double' if c.endswith('_entropy') else 'long'}" for c in (*_BASE, *measured))
    return map_slices(source, work, f"doc_id {kind}, band_group string, {types}")


def _ratios(name: str) -> dict[str, Column]:
    tokens = F.greatest(F.col(f"{name}_tokens"), F.lit(1))
    return {
        f"{name}_chars_per_token": F.col("word_chars") / tokens,
        f"{name}_byte_share": F.col(f"{name}_bytes") / tokens,
        f"{name}_relative_entropy": F.when(tokens > 1, F.col(f"{name}_entropy") / F.log2(tokens)).otherwise(1.0),
    }


def judge(
    docs: DataFrame,
    vocabularies: Sequence[Vocabulary],
    params: BandParams = BandParams(),
    id_col: str = "doc_id",
    text_col: str = "text",
    group_col: str | None = "lang",
) -> DataFrame:
    """``measure`` with ratios, ``base_failed`` and ``kept``. The measures are staged: they are read
    for the bands and again for the verdict, and texts are encoded once."""
    measured = measure(docs, vocabularies, id_col, text_col, group_col)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    ratios = {n: c for v in vocabularies for n, c in _ratios(v.name).items()}
    rows = stage(measured.withColumns(ratios).withColumn("base_failed", failed), "fertility")

    # Reach, floor and side of each band.
    bands: list[tuple[str, float, str]] = []
    for v in vocabularies:
        bands += [
            (f"{v.name}_chars_per_token", params.chars_floor, "both"),
            (f"{v.name}_byte_share", params.bytes_floor, "high"),
            (f"{v.name}_entropy", params.entropy_floor, "low"),
            (f"{v.name}_relative_entropy", params.relative_floor, "low"),
        ]
    quartiles = [F.percentile_approx(c, [0.25, 0.75], 1000).alias(f"q_{c}") for c, _, _ in bands]
    passed = rows.where(~F.col("base_failed"))
    # Staged, so that its size decides how it is joined and a hot language is no single task.
    own = stage(passed.groupBy("band_group").agg(F.count(F.lit(1)).alias("band_documents"), *quartiles), "bands")
    # One row for all documents; groups are few, and both are aggregated before the shuffle.
    every = passed.agg(*[q.alias(f"all_{c}") for q, (c, _, _) in zip(quartiles, bands, strict=True)])
    joined = rows.join(own, "band_group", "left").join(F.broadcast(every), F.lit(True), "left")
    enough = F.coalesce(F.col("band_documents"), F.lit(0)) >= params.least_documents

    def outside(column: str, floor: float, side: str) -> Column:
        quarter = F.when(enough, F.col(f"q_{column}")).otherwise(F.col(f"all_{column}"))
        reach = params.reach * F.greatest(quarter[1] - quarter[0], F.lit(floor))
        low, high = F.col(column) < quarter[0] - reach, F.col(column) > quarter[1] + reach
        return F.coalesce({"both": low | high, "low": low, "high": high}[side], F.lit(False))

    found = {c: outside(c, floor, side) for c, floor, side in bands}
    rejected = F.lit(False)
    for v in vocabularies:
        low_entropy = found[f"{v.name}_entropy"] & found[f"{v.name}_relative_entropy"]
        rejected = rejected | found[f"{v.name}_chars_per_token"] | found[f"{v.name}_byte_share"] | low_entropy
    kept = (~F.col("base_failed")) & ~rejected
    return joined.select("doc_id", *_BASE, "base_failed", kept.alias("kept"), *[c for c, _, _ in bands])
