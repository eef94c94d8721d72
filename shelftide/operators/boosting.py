"""Boosted regression trees by second-order histograms, and their compilation to column expressions.

Every feature is cut into at most 255 bins, one byte a value, with a bin of its own for absent values. A tree grows
level by level. Per level every task adds up, for each (feature, node, bin), the gradients and the number of its rows;
the sums of a feature meet in one task, which looks for the best cut of every node and returns one row for
each; the driver takes the best feature. So what is shuffled depends on the tasks, features, nodes and bins, and what
reaches the driver on features and nodes, never on the rows.

For squared error the gradient of a row is forecast minus target and its hessian 1. With sums G and H on a side and
T(G) = sign(G) max(|G| - alpha, 0), a cut gains (T(GL)^2/(HL+lambda) + T(GR)^2/(HR+lambda) - T(G)^2/(H+lambda)) / 2;
both sides need a hessian of ``min_child_weight``. Absent values go to the side that gains more (to the right, if none
does), and a leaf is worth -T(G)/(H+lambda) times the learning rate. Columns are drawn for each tree, rows for each tree by a
hash, so a row is in or out wherever it lies.

Gradients are rounded to whole numbers of about 30 bits before they are added, so the sums, and with them the trees, are the
same for any partitioning and after any lost executor. The forecasts so far are staged every few trees; between, a pass
applies the last trees itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftide.functions.exact import mean_of, moments
from shelftide.params import TreeParams
from shelftide.sources.shared import fresh_path
from shelftide.sources.sinks import stage

# The bin of absent values; the others are 0 to 254.
ABSENT_BIN = 255
# A cut must gain more than this.
LEAST_GAIN = 1e-6
# Features of this many values or fewer have a cut at each of them.
MOST_CUTS = 254
# Rows that one task adds up, some tens of milliseconds; fewer would cost more to start than to run.
TASK_ROWS = 100_000
# Tasks for each core at most: a level shuffles sums for each task, which must not grow with the rows without end.
CORE_TASKS = 4


@dataclass(frozen=True)
class Tree:
    """Nodes in the order of a heap: the children of node k are 2k+1 and 2k+2. ``feature`` is -1 for a leaf and for
    places without a node. A row goes left if its value is at most ``cut`` (its bin at most ``bin``)."""

    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    absent_left: np.ndarray
    value: np.ndarray


@dataclass(frozen=True)
class Ensemble:
    features: tuple[str, ...]
    base: float
    trees: tuple[Tree, ...]


# Bins


def feature_value(name: str) -> Column:
    """The feature as a double; NaN is absent like NULL."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def find_cuts(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Ascending cut points of each feature: all its values if they are few, else quantiles of a mergeable sketch, one
    aggregate for all features."""
    most = min(max_bins - 2, MOST_CUTS)
    values = rows.select(*[feature_value(f).alias(f"f{k}") for k, f in enumerate(features)])
    names = values.columns
    counts = values.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    few = [c for c in names if counts[c] <= 1.2 * most + 2]
    many = [c for c in names if c not in few]
    found: dict[str, list[float]] = {c: [] for c in names}
    if few:
        # Few values each, so their list is short.
        cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few])
        for r in values.select(F.explode(cells).alias("x")).select("x.*").where("v IS NOT NULL").distinct().collect():
            found[r["c"]].append(r["v"])
    wide = many + [c for c in few if len(found[c]) > most]
    if wide:
        shares = [k / most for k in range(1, most + 1)]
        quantiles = values.agg(*[F.percentile_approx(c, shares, 20_000).alias(c) for c in wide]).first()
        found |= {c: quantiles[c] or [] for c in wide}
    return [np.unique(np.array(found[c], float)) for c in names]


def binned(rows: DataFrame, features: Sequence[str], cuts: list[np.ndarray], target: str, keys: Sequence[str]) -> DataFrame:
    """(bins, y, row): a byte per feature, the target, and a hash of the keys for the draw of rows."""
    source = rows.where(F.col(target).isNotNull()).select(
        *[feature_value(f).alias(f"f{k}") for k, f in enumerate(features)], F.col(target).cast("double").alias("y"), F.xxhash64(*keys).alias("row")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = np.empty((batch.num_rows, len(cuts)), np.uint8)
            for k, cut in enumerate(cuts):
                column = batch.column(k)
                value = column.to_numpy(zero_copy_only=False).astype(float)
                matrix[:, k] = np.where(np.isnan(value), ABSENT_BIN, np.searchsorted(cut, value, side="left"))
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * len(cuts)
            bins = pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))])
            yield pa.RecordBatch.from_arrays([bins, batch.column("y"), batch.column("row")], ["bins", "y", "row"])

    return source.mapInArrow(work, "bins binary, y double, row long")


def _bins(batch: pa.RecordBatch, count: int) -> np.ndarray:
    column = batch.column("bins")
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(column.buffers()[2], np.uint8, len(column) * count, start).reshape(-1, count)


# Growing


def leaves(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row after ``depth`` steps down, or the leaf above it."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(depth):
        feature = tree.feature[node]
        inner = feature >= 0
        if not inner.any():
            break
        seen = bins[rows, np.maximum(feature, 0)]
        left = np.where(seen == ABSENT_BIN, tree.absent_left[node], seen <= tree.bin[node])
        node = np.where(inner, 2 * node + 2 - left, node)
    return node


def _mixed(row: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixture of row hash and seed (a multiply-xorshift finaliser)."""
    x = row.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _drawn(row: np.ndarray, share: float, seed: int) -> np.ndarray:
    return _mixed(row, seed) < np.uint64(min(int(share * 2.0**64), 2**64 - 1)) if share < 1 else np.ones(len(row), bool)


def thresholded(gradient: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - alpha, 0.0)


def _score(gradient: np.ndarray, hessian: np.ndarray, params: TreeParams) -> np.ndarray:
    t = thresholded(gradient, params.reg_alpha)
    weight = hessian + params.reg_lambda
    # A side without rows has no gradient either.
    return t * t / np.where(weight > 0, weight, 1.0)


def best_cuts(gradients: np.ndarray, counts: np.ndarray, scale: float, params: TreeParams) -> list[tuple]:
    """For every node (rows) the best cut over the bins (columns) of one feature: (gain, bin, absent goes left, gradient and
    rows on the left, gradient and rows in all). Among equal gains absent values go right and the lowest bin counts."""
    total, rows = gradients.sum(axis=1), counts.sum(axis=1)
    left, left_rows = gradients[:, :ABSENT_BIN].cumsum(axis=1), counts[:, :ABSENT_BIN].cumsum(axis=1)
    sides = [(left, left_rows), (left + gradients[:, [ABSENT_BIN]], left_rows + counts[:, [ABSENT_BIN]])]
    gains = []
    for g, h in sides:
        other, other_rows = total[:, None] - g, rows[:, None] - h
        gain = 0.5 * ((_score(g / scale, h, params) + _score(other / scale, other_rows, params)) - _score(total / scale, rows, params)[:, None])
        gains.append(np.where((h >= params.min_child_weight) & (other_rows >= params.min_child_weight) & (h > 0) & (other_rows > 0), gain, -np.inf))
    both = np.concatenate(gains, axis=1)
    at = both.argmax(axis=1)
    out = []
    for node, k in enumerate(at.tolist()):
        side, cut = divmod(k, ABSENT_BIN)
        g, h = sides[side]
        out.append((float(both[node, k]), cut, bool(side), int(g[node, cut]), int(h[node, cut]), int(total[node]), int(rows[node])))
    return out


_BEST = "feature int, node int, gain double, bin int, absent_left boolean, left long, left_rows long, total long, rows long"


def _level(data: DataFrame, recent: list[Tree], tree: Tree, depth: int, columns: np.ndarray, draw: tuple[float, int], scale: float, width: int, params: TreeParams, tasks: int) -> list:
    """The best cut of every node of a level for every drawn column."""
    nodes, first = 1 << depth, (1 << depth) - 1

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(columns) * nodes * 256
        gradients, counts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            bins, forecast = _bins(batch, width), batch.column("forecast").to_numpy()
            for t in recent:
                forecast = forecast + t.value[leaves(t, bins, params.max_depth)]
            node = leaves(tree, bins, depth) - first
            taken = (node >= 0) & _drawn(batch.column("row").to_numpy(), *draw)
            gradient = np.rint((forecast - batch.column("y").to_numpy())[taken] * scale)
            at = ((np.arange(len(columns)) * nodes + node[taken, None]) * 256 + bins[taken][:, columns]).reshape(-1)
            # Sums of a batch stay below 2^53, so doubles add them exactly.
            gradients += np.bincount(at, np.repeat(gradient, len(columns)), size).astype(np.int64)
            counts += np.bincount(at, minlength=size)
        both = np.stack([gradients.reshape(len(columns), -1), counts.reshape(len(columns), -1)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(columns, pa.int32()), pa.array([h.tobytes() for h in both], pa.binary())], ["feature", "sums"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for feature, held in zip(batch.column("feature").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[feature] = sums.get(feature, 0) + np.frombuffer(held, np.int64).reshape(2, nodes, 256)
        rows = [(f, n, *cut) for f, (g, h) in sums.items() for n, cut in enumerate(best_cuts(g, h, scale, params))]
        names = ["feature", "node", "gain", "bin", "absent_left", "left", "left_rows", "total", "rows"]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.bool_(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    if tasks == 1:
        # Nothing to bring together.
        return data.mapInArrow(lambda batches: search(histogram(batches)), _BEST).collect()
    parts = min(len(columns), tasks, int(data.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return data.mapInArrow(histogram, "feature int, sums binary").repartition(parts, "feature").mapInArrow(search, _BEST).collect()


def _grow(data: DataFrame, recent: list[Tree], cuts: list[np.ndarray], columns: np.ndarray, draw: tuple[float, int], scale: float, params: TreeParams, tasks: int) -> Tree:
    size = (1 << (params.max_depth + 1)) - 1
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size, bool), np.zeros(size))
    sums: dict[int, tuple[int, int]] = {}
    for depth in range(params.max_depth):
        first, split = (1 << depth) - 1, False
        found: dict[int, tuple] = {}
        for r in _level(data, recent, tree, depth, columns, draw, scale, len(cuts), params, tasks):
            node = first + r["node"]
            if not r["rows"]:
                continue
            if depth == 0:
                sums[0] = (r["total"], r["rows"])
            # The best gain, of equal ones that of the first feature.
            if r["gain"] > LEAST_GAIN and (-r["gain"], r["feature"]) < found.get(node, ((math.inf, 0), None))[0]:
                found[node] = ((-r["gain"], r["feature"]), r)
        for node, (_, r) in found.items():
            split = True
            tree.feature[node], tree.bin[node], tree.absent_left[node] = r["feature"], r["bin"], r["absent_left"]
            cut = cuts[r["feature"]]
            # Beyond the last cut there are only values that were never seen.
            tree.cut[node] = cut[r["bin"]] if r["bin"] < len(cut) else math.inf
            sums[2 * node + 1] = (r["left"], r["left_rows"])
            sums[2 * node + 2] = (r["total"] - r["left"], r["rows"] - r["left_rows"])
        if not split:
            break
    for node, (gradient, rows) in sums.items():
        if tree.feature[node] < 0:
            t = float(thresholded(np.float64(gradient / scale), params.reg_alpha))
            tree.value[node] = (-t / (rows + params.reg_lambda)) * params.learning_rate
    return tree


def _advanced(data: DataFrame, trees: list[Tree], depth: int, width: int) -> DataFrame:
    """The rows with the last trees added to their forecasts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, forecast = _bins(batch, width), batch.column("forecast").to_numpy()
            for t in trees:
                forecast = forecast + t.value[leaves(t, bins, depth)]
            yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), batch.column("row"), pa.array(forecast)], ["bins", "y", "row", "forecast"])

    return data.mapInArrow(add, data.schema)


def _errors(data: DataFrame, trees: list[Tree], depth: int, width: int) -> list[float]:
    """The mean squared error after each of the last trees: one row of sums a task."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros(len(trees)), 0
        for batch in batches:
            bins, forecast, y = _bins(batch, width), batch.column("forecast").to_numpy(), batch.column("y").to_numpy()
            rows += len(y)
            for k, t in enumerate(trees):
                forecast = forecast + t.value[leaves(t, bins, depth)]
                sums[k] += ((forecast - y) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["rows", "sums"])

    found = data.mapInArrow(measure, "rows long, sums array<double>").collect()
    count = sum(r["rows"] for r in found)
    return [math.fsum(r["sums"][k] for r in found) / count for k in range(len(trees))] if count else []


def boost(rows: DataFrame, holdout: DataFrame | None, features: Sequence[str], target: str, keys: Sequence[str], params: TreeParams, seed: int) -> tuple[Ensemble, list[float]]:
    """The trees, and the mean squared error on ``holdout`` after each of them (empty without rows there). Rows
    without a target are left out."""
    spark = rows.sparkSession
    known = rows.where(F.col(target).isNotNull())
    facts = known.agg(*[c.alias(n) for n, c in moments(F.col(target)).items()], F.max(target).alias("most"), F.min(target).alias("least"))
    facts = facts.select("n", mean_of().alias("mean"), "most", "least").first()
    if not facts["n"]:
        return Ensemble(tuple(features), 0.0, ()), []
    base = facts["mean"]
    cuts = find_cuts(known, features, params.max_bins)
    width = len(cuts)
    folder = fresh_path(spark, "boosting")
    tasks = min(math.ceil(facts["n"] / TASK_ROWS), CORE_TASKS * spark.sparkContext.defaultParallelism)
    packed = lambda df, name: stage(df, f"{folder}/{name}").coalesce(tasks)
    start = lambda df, name: packed(binned(df, features, cuts, target, keys).withColumn("forecast", F.lit(base)), f"{name}_0")
    data = {"train": start(rows, "train")} | ({"holdout": start(holdout, "holdout")} if holdout is not None else {})
    # Whole numbers of 30 bits for the largest gradient, of fewer where so many rows would leave 63 bits.
    spread = max(float(facts["most"]) - base, base - float(facts["least"]), 1e-9)
    bits = min(30, 61 - math.ceil(math.log2(facts["n"])) if facts["n"] > 1 else 30)
    scale = 2.0 ** (bits - math.ceil(math.log2(spread)))
    pick = np.random.default_rng(seed)
    taken = max(1, round(params.colsample_bytree * width))
    trees: list[Tree] = []
    recent: list[Tree] = []
    errors: list[float] = []
    for number in range(params.n_estimators):
        columns = np.sort(pick.permutation(width)[:taken])
        tree = _grow(data["train"], recent, cuts, columns, (params.subsample, seed * 1_000_003 + number + 1), scale, params, tasks)
        trees.append(tree)
        recent.append(tree)
        last = number + 1 == params.n_estimators
        if last or len(recent) == params.checkpoint_interval:
            if "holdout" in data:
                errors += _errors(data["holdout"], recent, params.max_depth, width)
            if not last:
                data = {name: packed(_advanced(df, recent, params.max_depth, width), f"{name}_{number + 1}") for name, df in data.items()}
            recent = []
    _delete(spark, folder)
    return Ensemble(tuple(features), base, tuple(trees)), errors


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Scoring


def _number(x: float) -> str:
    """A literal with an exponent, a double in any SQL."""
    return f"{x:.17e}"


def tree_sql(tree: Tree, features: Sequence[str], quote: Callable[[str], str], node: int = 0) -> str:
    """The tree as nested CASE over columns of doubles."""
    k = int(tree.feature[node])
    if k < 0:
        return _number(tree.value[node])
    name = quote(features[k])
    left = [] if math.isinf(tree.cut[node]) else [f"{name} <= {_number(tree.cut[node])}"]
    if math.isinf(tree.cut[node]):
        left.append(f"{name} IS NOT NULL AND NOT isnan({name})")
    if tree.absent_left[node]:
        left.append(f"{name} IS NULL OR isnan({name})")
    sides = [tree_sql(tree, features, quote, 2 * node + 1), tree_sql(tree, features, quote, 2 * node + 2)]
    return f"CASE WHEN {' OR '.join(left)} THEN {sides[0]} ELSE {sides[1]} END"


def ensemble_sql(model: Ensemble, quote: Callable[[str], str] = lambda c: f'"{c}"') -> str:
    """The forecast as one SQL expression: the base, then the trees in order. The features must be columns of doubles."""
    return " + ".join([_number(model.base), *[f"({tree_sql(t, model.features, quote)})" for t in model.trees]])


def ensemble_column(model: Ensemble) -> Column:
    """The forecast as a column expression over doubles named ``x_<feature>``. The trees are added in order by a fold over
    an array, so no generated method has to hold all of them."""
    quote = lambda c: f"`x_{c}`"
    if not model.trees:
        return F.lit(model.base)
    trees = ", ".join(tree_sql(t, model.features, quote) for t in model.trees)
    return F.expr(f"aggregate(array({trees}), {_number(model.base)}, (a, t) -> a + t)")


def scored(rows: DataFrame, model: Ensemble, output: str) -> DataFrame:
    """``rows`` with the forecast in ``output``."""
    inputs = rows.withColumns({f"x_{f}": feature_value(f) for f in model.features})
    return inputs.withColumn(output, ensemble_column(model)).select(*rows.columns, output)


# Storage

_NODES = "tree int, node int, feature int, bin long, cut double, absent_left boolean, value double"


def node_table(spark: SparkSession, model: Ensemble) -> DataFrame:
    """One row per node; the base is the value of tree -1."""
    rows = [(-1, 0, -1, 0, 0.0, False, float(model.base))]
    for k, t in enumerate(model.trees):
        used, reached = np.zeros(len(t.feature), bool), [0]
        while reached:
            node = reached.pop()
            used[node] = True
            if t.feature[node] >= 0:
                reached += [2 * node + 1, 2 * node + 2]
        rows += [
            (k, int(n), int(t.feature[n]), int(t.bin[n]), float(t.cut[n]), bool(t.absent_left[n]), float(t.value[n])) for n in np.flatnonzero(used)
        ]
    return spark.createDataFrame(rows, _NODES)


def from_nodes(table: DataFrame, features: Sequence[str]) -> Ensemble:
    rows = table.orderBy("tree", "node").collect()
    base = next(r["value"] for r in rows if r["tree"] < 0)
    held: dict[int, list] = {}
    for r in rows:
        if r["tree"] >= 0:
            held.setdefault(r["tree"], []).append(r)
    trees = []
    for k in sorted(held):
        size = (1 << (max(r["node"] for r in held[k]) + 1).bit_length()) - 1
        tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(size, bool), np.zeros(size))
        for r in held[k]:
            n = r["node"]
            tree.feature[n], tree.bin[n], tree.cut[n], tree.absent_left[n], tree.value[n] = r["feature"], r["bin"], r["cut"], r["absent_left"], r["value"]
        trees.append(tree)
    return Ensemble(tuple(features), base, tuple(trees))
