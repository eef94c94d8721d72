"""Toxicity by non-negative positive-unlabelled learning.

The risk of a scorer on clean text is not measured on rows labelled clean but on unlabelled text, from
which the known share of toxic text (the class prior) is taken off:

    risk = prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic))

Where the part inside max() falls below zero the model overfits, and the step goes back up on that part
instead. The scorer is linear in the presence of hashed words and word beginnings; those much
more frequent in confirmed toxic text than in unlabelled text are used. It is fitted
with numpy on bounded samples (``PUParams``), then its output is turned into a probability on
labelled rows (a fitted slope and offset).

Labels of held-out ids (see ``labelled_sample``) are never read; language, source and ids are no inputs.

Defined results: NULL and empty texts have the score of a text without any known word. Without
any confirmed toxic row every score is the prior. Of labels that contradict each other under one id the largest counts;
repeated rows each get a row, and all of them stay or go; no rows give no rows. Texts of any length are worked on whole, a few megabytes of
documents at a time. `drop_toxic` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import lean, map_slices, release_held, text_slices, unused_name
from shelftide.llm.decontamination import words_of
from shelftide.llm.labelled_sample import held_out, sample_ids, with_texts

BUCKET_BITS = 20
PREFIXES = (4, 5)
THRESHOLD = 0.3
CACHE_WORDS = 150_000


@dataclass(frozen=True)
class PUParams:
    """Bounds of the samples (rows), and how the model is fitted."""

    positives: int = 4000
    unlabelled: int = 8000
    calibration: int = 8000
    features: int = 1024
    least_z: float = 5.5
    least_texts: int = 3
    steps: int = 300
    rate: float = 0.1
    ridge: float = 1e-4


@dataclass
class ToxicityModel:
    """``weights`` by hashed feature; ``slope`` and ``offset`` turn a margin into a log-odds."""

    features: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margins + self.offset)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def word_features(word: bytes) -> list[int]:
    """The buckets of a word and of its beginnings."""
    text = word.decode()
    parts = [b"w" + word, *(b"p%d" % n + text[:n].encode() for n in PREFIXES if len(text) >= n)]
    return [xxhash.xxh3_64_intdigest(p) >> (64 - BUCKET_BITS) for p in parts]


def text_features(data: bytes | None) -> np.ndarray:
    return np.unique(np.array([f for w in set(words_of(data)) for f in word_features(w)], np.int64))


def _collected(sample: DataFrame) -> dict[str, tuple[list[np.ndarray], np.ndarray]]:
    """Feature lists and labels of a bounded sample by role, in the order of the ids."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        lists = [text_features(x).astype(np.int32).tobytes() for x in part.column("data").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [part.column("sample_id"), part.column("role"), part.column("label"), pa.array(lists, pa.binary())],
            ["sample_id", "role", "label", "features"],
        )

    source = sample.select("sample_id", "role", F.col("label").cast("int").alias("label"), "data")
    rows = map_slices(source, work, "sample_id long, role string, label int, features binary").collect()
    rows.sort(key=lambda r: (r["sample_id"], bytes(r["features"])))
    found = {}
    for role in ("confirmed", "background", "graded"):
        own = [r for r in rows if r["role"] == role]
        found[role] = [np.frombuffer(bytes(r["features"]), np.int32) for r in own], np.array([r["label"] for r in own], float)
    return found


def _selected(positive: list[np.ndarray], unlabelled: list[np.ndarray], params: PUParams) -> np.ndarray:
    """Features that toxic texts have more often than unlabelled ones, by the z-score of the two shares."""
    buckets = 1 << BUCKET_BITS
    seen = [np.bincount(np.concatenate(x or [np.empty(0, np.int32)]), minlength=buckets) for x in (positive, unlabelled)]
    n, m = max(len(positive), 1), max(len(unlabelled), 1)
    pooled = (seen[0] + seen[1] + 1) / (n + m + 2)
    z = (seen[0] / n - seen[1] / m) / np.sqrt(pooled * (1 - np.minimum(pooled, 1 - 1e-9)) * (1 / n + 1 / m))
    z[seen[0] < params.least_texts] = 0
    found = np.flatnonzero(z >= params.least_z)
    return np.sort(found[np.argsort(-z[found], kind="stable")[: params.features]])


def _design(lists: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lists), len(features)), np.float32)
    for k, x in enumerate(lists):
        at = np.searchsorted(features, x)
        at = at[at < len(features)]
        hit = np.intersect1d(features, x, assume_unique=True, return_indices=True)[1] if len(at) else at
        out[k, hit] = 1
    return out


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, params: PUParams) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss (Adam)."""
    size = positive.shape[1]
    theta = np.zeros(size + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, params.steps + 1):
        at_p = positive @ theta[:-1] + theta[-1]
        at_u = unlabelled @ theta[:-1] + theta[-1]
        # Loss of calling toxic clean is log(1 + e^-f), of calling clean toxic log(1 + e^f).
        negative = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        up_u, up_p = _sigmoid(at_u) / len(at_u), prior * _sigmoid(at_p) / len(at_p)
        pull = -prior * _sigmoid(-at_p) / len(at_p)
        if negative >= 0:
            on_p, on_u = pull - up_p, up_u
        else:
            on_p, on_u = up_p, -up_u
        gradient = np.concatenate([positive.T @ on_p + unlabelled.T @ on_u, [on_p.sum() + on_u.sum()]])
        gradient[:-1] += params.ridge * theta[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta -= params.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _calibrated(margins: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the log-odds (Newton steps, smoothed labels)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(design @ at)
        gradient = design.T @ (p - target) + 1e-3 * (at - [1.0, 0.0])
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, gradient)
        at = at - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def train(
    docs: DataFrame, labels: DataFrame, params: PUParams = PUParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(F.col(id_col))).select(id_col, F.col(label_col).cast("int").alias("label"))
    unknown = docs.where(~held_out(F.col(id_col))).select(id_col)
    # All samples are bounded, so one scan of the texts serves the three of them.
    samples = {
        "confirmed": sample_ids(known.where("label = 1"), id_col, params.positives, ["label"]),
        "background": sample_ids(unknown, id_col, params.unlabelled).withColumn("label", F.lit(0)),
        "graded": sample_ids(known, id_col, params.calibration, ["label"]),
    }
    chosen = [ids.select(id_col, "label", F.lit(role).alias("role")) for role, ids in samples.items()]
    found = _collected(with_texts(reduce(DataFrame.unionByName, chosen), docs, id_col, text_col))
    (confirmed, _), (background, _), (graded, truth) = found["confirmed"], found["background"], found["graded"]
    share = (truth.sum() + 0.5) / (len(truth) + 1.0)
    prior = float(np.clip(share, 1e-3, 0.999))
    base = float(np.log(prior / (1 - prior)))
    if not confirmed or not background:
        return ToxicityModel(bias=base)
    # Copies of one toxic text would make all its words look toxic.
    different = list({x.tobytes(): x for x in confirmed}.values())
    features = _selected(different, background, params)
    if not len(features):
        return ToxicityModel(bias=base)
    weights, bias = fit_pu(_design(confirmed, features), _design(background, features), prior, params)
    slope, offset = _calibrated(_design(graded, features) @ weights + bias, truth)
    return ToxicityModel(features, weights, bias, slope, offset)


class _Scorer:
    """Margins of texts. The weighted features of a word are kept; most words have none."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
        self.words: dict[bytes, tuple[int, ...]] = {}

    def margin(self, data: bytes | None) -> float:
        found: set[int] = set()
        known = self.words
        for word in set(words_of(data)):
            held = known.get(word)
            if held is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                held = known[word] = tuple(f for f in word_features(word) if f in self.weight)
            if held:
                found.update(held)
        return self.model.bias + sum(self.weight[f] for f in sorted(found))


def add_scores(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic (replacing a column of that name)."""
    columns = [c for c in docs.columns if c.lower() != score_col.lower() or c == text_col]
    data = unused_name([*columns, score_col], "data")
    source = docs.select(*columns, F.col(text_col).cast("binary").alias(data))
    schema = docs.select(*columns).schema.add(score_col, "double")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_held()
        scorer = _Scorer(shared.value)
        for batch in batches:
            for part in text_slices(batch, data):
                margins = np.array([scorer.margin(x) for x in part.column(data).to_pylist()])
                arrays = [part.column(c) for c in part.schema.names if c != data]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(scorer.model.probability(margins))], schema.names)

    return source.mapInArrow(lean(score), schema)


def score_documents(docs: DataFrame, labels: DataFrame, params: PUParams = PUParams()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = add_scores(docs.select("doc_id", "text"), train(docs, labels, params))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, params: PUParams = PUParams(), threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those scored ``threshold`` or more; all columns kept."""
    score = unused_name(docs.columns, "toxic_score")
    return add_scores(docs, train(docs, labels, params), score_col=score).where(F.col(score) < threshold).drop(score)
