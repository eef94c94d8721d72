"""Quality grades by ordinal cumulative-link regression.

One weight vector over hashed text features serves all grades; ordered thresholds cut its score:

    P(grade <= k) = sigmoid(threshold_k - score)

so grades differ in where they are cut and not in what is measured. Out come the expected grade
and the tail probability P(grade >= wanted), by which documents are selected.

Features are shares of a text's words: hashed words, hashed shapes of words (letter case, digits, marks),
hashed pairs of neighbouring shapes, and repetition of the word before; square roots of the
shares, so that a rare mark still counts. Weights and thresholds are fitted with numpy on a
bounded sample of graded rows (``OrdinalParams.sample``); labels of held-out ids are never read.

Defined results: NULL and wordless texts have no features and get the grade probabilities of a
zero score. Without graded rows, every grade is equally likely. Of labels that contradict each other under one id the
largest counts; repeated rows each get a row; no rows give no rows. Texts of any length are worked on whole, a few megabytes of
documents at a time.
Other columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import map_slices, mix, text_slices, unused_name
from shelftide.llm.labelled_sample import held_out, sample_ids, with_texts

WORD_BUCKETS = 1 << 13
SHAPE_BUCKETS = 1 << 11
PAIR_BUCKETS = 1 << 12
# Word, shape and pair buckets, then two for repetition.
SIZE = WORD_BUCKETS + SHAPE_BUCKETS + PAIR_BUCKETS + 2
CACHE_WORDS = 400_000

# ASCII by kind: letters a or A, digits 0, other marks stay; bytes beyond ASCII count as small letters.
_SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)


@dataclass(frozen=True)
class OrdinalParams:
    sample: int = 6000
    grades: int = 3
    steps: int = 300
    rate: float = 0.05
    ridge: float = 1e-4


@dataclass
class OrdinalModel:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(SIZE))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def below(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) for every k but the last, one row per score."""
        return _sigmoid(self.thresholds[None, :] - scores[:, None])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _shape(word: bytes) -> bytes:
    """Kinds of characters, runs of one kind written once or (two and more) twice."""
    kinds = word.translate(_SHAPE)
    return bytes(k for i, k in enumerate(kinds) if i < 2 or not kinds[i - 2] == kinds[i - 1] == k)


class Features:
    """Feature vectors of texts. What a word stands for is kept for its next occurrence."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}

    def _code(self, words: list[bytes]) -> np.ndarray:
        """A 64-bit number per word: 41 bits of its hash, then the shape bucket."""
        known = self.words
        fresh = set(words).difference(known)
        if len(known) + len(fresh) > CACHE_WORDS:
            known.clear()
            fresh = set(words)
        for w in fresh:
            shape = xxhash.xxh3_64_intdigest(_shape(w)) % SHAPE_BUCKETS
            known[w] = (xxhash.xxh3_64_intdigest(w) >> 23) * SHAPE_BUCKETS + shape
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def vector(self, data: bytes | None) -> np.ndarray:
        words = data.split() if data else []
        out = np.zeros(SIZE)
        if not words:
            return out
        code = self._code(words)
        word, shape = (code // SHAPE_BUCKETS) % WORD_BUCKETS, code % SHAPE_BUCKETS
        pairs = mix((shape[:-1] * SHAPE_BUCKETS + shape[1:]).astype(np.uint64)) % np.uint64(PAIR_BUCKETS)
        at = np.concatenate([word, WORD_BUCKETS + shape, WORD_BUCKETS + SHAPE_BUCKETS + pairs.astype(np.int64)])
        out += np.bincount(at, minlength=SIZE)
        out[-2] = np.count_nonzero(code[1:] == code[:-1])
        out[-1] = len(words) - len(np.unique(code))
        return np.sqrt(out / len(words))


class SparseRows:
    """Rows of (feature, value) as flat arrays with the number of each entry's row."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.count = len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(at) for at, _ in rows])
        self.feature = np.concatenate([at for at, _ in rows] or [np.empty(0, np.int32)])
        self.value = np.concatenate([v for _, v in rows] or [np.empty(0, np.float32)]).astype(float)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * weights[self.feature], minlength=self.count)

    def gradient(self, on_scores: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, weights=self.value * on_scores[self.row], minlength=SIZE)


def fit(rows: SparseRows, grades: np.ndarray, params: OrdinalParams) -> OrdinalModel:
    """Maximum likelihood with a ridge (Adam). Thresholds are a first one and positive gaps, so
    they stay in order."""
    n, k = len(grades), params.grades
    if not n:
        return OrdinalModel(thresholds=np.log(np.arange(1, k) / np.arange(k - 1, 0, -1)))
    share = np.cumsum([(np.sum(grades == g) + 0.5) / (n + 0.5 * k) for g in range(k)])[:-1]
    cuts = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(SIZE), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    row = np.arange(n)
    for step in range(1, params.steps + 1):
        gaps = np.exp(theta[SIZE + 1 :])
        cuts = theta[SIZE] + np.concatenate([[0.0], np.cumsum(gaps)])
        below = _sigmoid(cuts[None, :] - rows.scores(theta[:SIZE])[:, None])
        padded = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
        p = np.maximum(padded[row, grades + 1] - padded[row, grades], 1e-12)
        slope = padded * (1 - padded)
        up, down = slope[row, grades + 1] / p, slope[row, grades] / p
        on_scores = (up - down) / n  # of the negative log-likelihood
        on_cuts = np.bincount(grades + 1, weights=-up / n, minlength=k + 1) + np.bincount(grades, weights=down / n, minlength=k + 1)
        later = np.cumsum(on_cuts[1:k][::-1])[::-1]
        gradient = np.concatenate([rows.gradient(on_scores) + params.ridge * theta[:SIZE], later[:1], later[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= params.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(theta[SIZE + 1 :])
    return OrdinalModel(theta[:SIZE], theta[SIZE] + np.concatenate([[0.0], np.cumsum(gaps)]))


def train(docs: DataFrame, graded: DataFrame, params: OrdinalParams = OrdinalParams(), id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """``graded`` has the id and an integer ``grade`` from 0 to ``params.grades`` - 1."""
    known = graded.where(F.col("grade").between(0, params.grades - 1) & ~held_out(F.col(id_col))).select(id_col, "grade")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        features, rows = Features(), []
        for data in part.column("data").to_pylist():
            vector = features.vector(data).astype(np.float32)
            at = np.flatnonzero(vector)
            rows.append(at.astype(np.int32).tobytes() + vector[at].tobytes())
        return pa.RecordBatch.from_arrays(
            [part.column("sample_id"), part.column("grade"), pa.array(rows, pa.binary())], ["sample_id", "grade", "vector"]
        )

    sample = with_texts(sample_ids(known, id_col, params.sample, ["grade"]), docs, id_col, text_col)
    source = sample.select("sample_id", F.col("grade").cast("int").alias("grade"), "data")
    rows = map_slices(source, work, "sample_id long, grade int, vector binary").collect()
    rows.sort(key=lambda r: (r["sample_id"], bytes(r["vector"])))
    sparse = []
    for r in rows:
        held = bytes(r["vector"])
        half = len(held) // 2
        sparse.append((np.frombuffer(held[:half], np.int32), np.frombuffer(held[half:], np.float32)))
    return fit(SparseRows(sparse), np.array([r["grade"] for r in rows], np.int64), params)


def add_grades(docs: DataFrame, model: OrdinalModel, least_grade: int, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with ``expected_grade`` and ``tail_probability`` (of ``least_grade`` or better),
    replacing columns of those names."""
    added = [f"{prefix}expected_grade", f"{prefix}tail_probability"]
    columns = [c for c in docs.columns if c.lower() not in added or c == text_col]
    data = unused_name([*columns, *added], "data")
    source = docs.select(*columns, F.col(text_col).cast("binary").alias(data))
    schema = docs.select(*columns).schema
    for c in added:
        schema = schema.add(c, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, model = Features(), shared.value
        for batch in batches:
            for part in text_slices(batch, data):
                scores = np.array([features.vector(x) @ model.weights for x in part.column(data).to_pylist()])
                below = model.below(scores)
                expected = below.shape[1] - below.sum(axis=1)
                tail = 1.0 - below[:, least_grade - 1] if least_grade > 0 else np.ones(len(scores))
                arrays = [part.column(c) for c in part.schema.names if c != data]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(expected), pa.array(tail)], schema.names)

    return source.mapInArrow(grade, schema)


def graded_labels(labels: DataFrame, quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """Ratings from two labels: 0 is poor text, 1 good but toxic text, 2 good text."""
    good: Column = F.col(quality) == 1
    return labels.withColumn("grade", F.when(F.col(quality) == 0, 0).when(good & (F.col(toxic) == 1), 1).when(good & (F.col(toxic) == 0), 2))


def grade_documents(
    docs: DataFrame, labels: DataFrame, params: OrdinalParams = OrdinalParams(), least_grade: int = 1, least_probability: float = 0.5
) -> DataFrame:
    """One row per document: doc_id, held_out, expected_grade, tail_probability, kept."""
    graded = add_grades(docs.select("doc_id", "text"), train(docs, graded_labels(labels), params), least_grade)
    kept = F.col("tail_probability") >= least_probability
    return graded.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "expected_grade", "tail_probability", kept.alias("kept"))
