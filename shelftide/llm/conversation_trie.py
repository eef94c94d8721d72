"""Conversation prefix trie, rolled up by centroid decomposition of its parent edges.

A conversation is its turns in order. Each distinct sequence of first d turns (role, text) is a node of depth
d under the textless root; a conversation is a member of every node that it starts with. A node is named by
(its smallest member, its depth), which no other node has.

1. Turns get their positions from a range-partitioned sort of (conversation, turn) and the counts per range,
   so a conversation of very many turns lies in many ranges and in no single task.
2. A prefix is known by its depth and the sums of four 32-bit hashes of (position, role, text): 128 bits. Running
   sums are taken in blocks of 1,024 positions and carried over the sums of the blocks.
3. Nodes are an aggregate of the prefixes, partial before the shuffle: a first turn of very many conversations is
   one row a task. The member that names a node tells its ancestors: they are the prefixes of that
   conversation, found by (member, depth) without walking up.
4. Rollup. A component is a connected part of the trie; its top is its shallowest node. A node weighs what its
   members weigh below it inside the component (members count once per turn), so every node has a positive
   weight of its own. The nodes with more than half of the component's weight are a path down from the top,
   and the last of them is the centroid: below it and above it at most half is left. Per level: the values
   of the centroid's part (it and what hangs below it inside the component) are added up for each
   component, that total is added to every node of the path, the weights on the path drop by
   the centroid's, and the component falls apart into the parts below each child and the part above. Each
   pair of a node and a descendant is counted once: when the first centroid between them is taken out. The levels
   are at most the logarithm of the number of prefixes, however deep or wide the trie.
   Components of few nodes go on inside a task by the same steps, many of them side by side in numpy.

Defined results: rows without conv_id belong to no conversation and are left out. Turns go by ``turn`` (NULL
first), then role, then text; repeated rows are turns of their own. A NULL role or text is an empty one. A table
without conversations has no nodes, not even a root. Lengths of texts are code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelftide.llm.common import Scratch

# Positions whose running sums are taken together.
BLOCK = 1024
# Nodes of a component that a task finishes by itself.
LOCAL_NODES = 20_000
# Ids that are joined to one string before the hash of a node's ends.
_ID_BITS = 10
_LANES = ("s0", "s1", "s2", "s3")


def _position_in_order(rows: DataFrame, group: str, order: list[Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 1) inside ``group``: ranges are sorted apart and the counts of a group in
    earlier ranges are added."""
    ranged = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    placed = scratch.stage(ranged.withColumn("part", F.spark_partition_id()).withColumn("mark", F.monotonically_increasing_id()), f"{name}_sorted")
    counts = placed.groupBy(group, "part").agg(F.min("mark").alias("start"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("start")).alias("shift"))
    return placed.join(counts, [group, "part"]).withColumn("pos", F.col("mark") + F.col("shift")).drop("part", "mark", "shift")


def turns_in_order(conversations: DataFrame, scratch: Scratch, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, h0, h1, chars): each turn with its position and two hashes of role and text."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), filled(role_col).alias("role"), filled(text_col).alias("text")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = _position_in_order(rows, "conv", order, scratch, "turns")
    hashed = [F.xxhash64(F.lit(k), "role", "text").alias(f"h{k}") for k in range(2)]
    return placed.select("conv", "pos", *hashed, F.length("text").cast("long").alias("chars"))


def rebuilt(turns: DataFrame, scratch: Scratch, span: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c with its first h turns taken from conversation c - c % ``span`` (as many as that has),
    then its own turns after the first h; h is the CRC-32 of the decimal id modulo ``most``. Positions start at 1;
    (conv, 0) stands for the beginning and carries no turn."""
    turns = scratch.stage(turns, "turns")
    h = lambda c: (F.crc32(c.cast("string").cast("binary")) % most).cast("long")
    base = F.col("conv") - F.pmod("conv", F.lit(span))
    lengths = scratch.stage(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")), "lengths")
    bases = lengths.where(F.pmod("conv", F.lit(span)) == 0).select(F.col("conv").alias("base"), F.col("own").alias("given"))
    convs = lengths.select("conv", "own", h(F.col("conv")).alias("h"), base.alias("base")).join(bases, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("given", F.lit(0))))
    convs = scratch.stage(convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    # What a conversation takes from another one: less than ``most`` rows for each.
    heads = turns.where((F.pmod("conv", F.lit(span)) == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    borrowed = convs.select("conv", "base", "taken", "length").join(heads, "base").where("pos <= taken")
    left = turns.where(F.col("pos") > h(F.col("conv"))).join(convs.select("conv", "h", "taken", "length"), "conv")
    left = left.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("pos", "h0", "h1", "chars")]
    columns = ["conv", "pos", "h0", "h1", "chars", "length"]
    return borrowed.select(*columns).unionByName(left.select(*columns)).unionByName(convs.select("conv", *zero, "length"))


def prefixes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, pos, length, chars, s0..s3): each prefix with the sums of its turns' hashes. Lanes are 32-bit numbers, so
    their sums stay inside 64 bits for 2^31 turns."""
    low, high = F.lit(0xFFFFFFFF), 32
    both = [F.xxhash64("pos", "h0", "h1"), F.xxhash64("h1", "pos", "h0")]
    lanes = [x for b in both for x in (b.bitwiseAND(low), F.shiftrightunsigned(b, high))]
    lanes = [F.when(F.col("pos") > 0, x).otherwise(0) for x in lanes]
    blocked = rows.select("conv", "pos", "length", "chars", F.floor(F.col("pos") / BLOCK).alias("block"), *[x.alias(n) for x, n in zip(lanes, _LANES, strict=True)])
    blocked = scratch.stage(blocked, "blocked")
    inside = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocked.where(F.col("length") >= BLOCK).groupBy("conv", "block").agg(*[F.sum(n).alias(n) for n in _LANES])
    carried = carried.select("conv", "block", *[F.sum(n).over(earlier).alias(f"c{n}") for n in _LANES]).where("block > 0")
    summed = blocked.select("conv", "pos", "length", "chars", "block", *[F.sum(n).over(inside).alias(n) for n in _LANES])
    joined = summed.join(carried, ["conv", "block"], "left")
    return joined.select("conv", "pos", "length", "chars", *[(F.col(n) + F.coalesce(f"c{n}", F.lit(0))).alias(n) for n in _LANES])


# Rollup by centroids

_STATE = ("rep", "depth", "top", "top_depth", "weight", "leaves", "saved", "sum_leaves", "sum_saved")


def _local_rollup(parent: np.ndarray, component: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (a row per node) over all descendants, the node included, by centroid decomposition of
    many components side by side. ``parent``: index of the parent node, or the node itself for a top."""
    count = len(parent)
    sums = np.zeros_like(values)
    weight, alive, component = weight.copy(), np.ones(count, bool), component.copy()
    while alive.any():
        at = np.flatnonzero(alive)
        # Components numbered anew, their weight (that of the top is the largest) and their path.
        _, own = np.unique(component[at], return_inverse=True)
        pieces = own.max() + 1
        whole = np.zeros(pieces, np.int64)
        np.maximum.at(whole, own, weight[at])
        path = 2 * weight[at] > whole[own]
        deepest = np.full(pieces, -1, np.int64)
        order = np.flatnonzero(path)
        order = order[np.argsort(depth[at[order]], kind="stable")]
        deepest[own[order]] = at[order]
        # What hangs below the centroid: follow parents inside the piece until the centroid or the top is met.
        centroid = np.zeros(count, bool)
        centroid[deepest] = True
        up = np.arange(count)
        top = np.zeros(count, np.int64)
        top[at] = own
        inside = alive[parent[at]] & (component[parent[at]] == component[at]) & ~centroid[at]
        up[at[inside]] = parent[at[inside]]
        # Nodes right below the centroid end the walk.
        first = inside & centroid[parent[at]]
        up[at[first]] = at[first]
        below = np.zeros(count, bool)
        below[at[first]] = True
        while True:
            further = up[up[at]]
            if (further == up[at]).all():
                break
            up[at] = further
        hangs = below[up[at]] | centroid[at]
        totals = np.zeros((pieces, values.shape[1]), values.dtype)
        np.add.at(totals, own[hangs], values[at[hangs]])
        sums[at[path]] += totals[own[path]]
        weight[at[path]] -= weight[deepest][own[path]]
        component[at] = up[at]
        # The part above keeps its top; the centroid is done.
        alive[deepest] = False
    return sums


def _finish_small(state: DataFrame) -> DataFrame:
    """Rolls up components that each fit a task; rows come sorted by component and depth, and whole
    components are taken until there is enough work for a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: pa.Table) -> pa.RecordBatch:
            get = {c: rows.column(c).to_numpy() for c in (*_STATE, "parent")}
            is_top = get["depth"] == get["top_depth"]
            # Nodes by number: a node is its member's rank and its depth.
            ranks = np.unique(np.concatenate([get["rep"], get["parent"]]), return_inverse=True)[1].reshape(-1)
            layers = int(get["depth"].max()) + 1
            name = ranks[: rows.num_rows] * layers + get["depth"]
            order = np.argsort(name)
            wanted = np.where(is_top, name, ranks[rows.num_rows :] * layers + get["depth"] - 1)
            parent = order[np.searchsorted(name, wanted, sorter=order)]
            # Rows come sorted by their tops, so a component begins where the top changes.
            changes = (np.diff(get["top"]) != 0) | (np.diff(get["top_depth"]) != 0)
            component = np.concatenate([[0], np.cumsum(changes)])
            sums = _local_rollup(parent, component, get["depth"], get["weight"], np.column_stack([get["leaves"], get["saved"]]))
            done = [pa.array(get["rep"]), pa.array(get["depth"]), pa.array(get["sum_leaves"] + sums[:, 0]), pa.array(get["sum_saved"] + sums[:, 1])]
            return pa.RecordBatch.from_arrays(done, ["rep", "depth", "sum_leaves", "sum_saved"])

        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < LOCAL_NODES:
                continue
            together = pa.Table.from_batches(held)
            top, top_depth = together.column("top").to_numpy(), together.column("top_depth").to_numpy()
            others = np.flatnonzero((top != top[-1]) | (top_depth != top_depth[-1]))
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield solve(together.slice(0, cut))
            held = together.slice(cut).to_batches()
            rows -= cut
        if rows:
            yield solve(pa.Table.from_batches(held))

    return state.mapInArrow(run, "rep long, depth long, sum_leaves long, sum_saved long")


def centroid_rollup(nodes: DataFrame, ancestors: DataFrame, scratch: Scratch, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """(rep, depth, sum_leaves, sum_saved): the values of each node's subtree added up.

    ``nodes``: rep, depth, parent (rep of the parent), weight, leaves, saved. ``ancestors``: conv, pos, rep, parent: which node
    holds the first ``pos`` turns of a conversation, and whose child it is.
    """
    # The root holds every conversation; its member names the first component.
    root = nodes.where("depth = 0").first()["rep"]
    number = lambda x: F.lit(x).cast("long")
    state = nodes.select("rep", "depth", F.coalesce("parent", "rep").alias("parent"), number(root).alias("top"), number(0).alias("top_depth"), "weight", "leaves", "saved", number(0).alias("sum_leaves"), number(0).alias("sum_saved"))
    state, done, small = scratch.stage(state, "state"), [], []
    key = ["top", "top_depth"]
    while True:
        pieces = scratch.stage(state.groupBy(*key).agg(F.max("weight").alias("whole"), F.count(F.lit(1)).alias("n")), "pieces")
        sizes = pieces.agg(F.count_if(F.col("n") > local_nodes).alias("large"), F.count_if(F.col("n") <= local_nodes).alias("small")).first()
        if sizes["small"]:
            # The large ones are few: at most one for every ``local_nodes`` nodes.
            small.append(state.join(pieces.where(F.col("n") > local_nodes).select(*key), key, "left_anti") if sizes["large"] else state)
        if not sizes["large"]:
            break
        large = state.join(pieces.where(F.col("n") > local_nodes).drop("n"), key)
        path = large.where(2 * F.col("weight") > F.col("whole"))
        deepest = path.groupBy(*key).agg(F.min_by(F.struct("rep", "depth"), "weight").alias("c"), F.min("weight").alias("c_weight"), F.max("whole").alias("whole"))
        deepest = scratch.stage(deepest.select(*key, "whole", F.col("c.rep").alias("c_rep"), F.col("c.depth").alias("c_depth"), "c_weight"), "centroids")
        split = state.join(deepest, key)
        # The node one step below the centroid's depth over each deeper node: it hangs there if that one's parent is the centroid.
        step = ancestors.select(F.col("conv").alias("rep"), F.col("pos").alias("step"), F.col("rep").alias("s_rep"), F.col("parent").alias("s_parent"))
        deeper = split.where("depth > c_depth").withColumn("step", F.col("c_depth") + 1).join(step, ["rep", "step"])
        hangs = F.col("s_parent") == F.col("c_rep")
        deeper = deeper.withColumn("hangs", hangs).drop("step", "s_parent")
        level = split.where("depth <= c_depth").withColumn("s_rep", F.lit(None).cast("long")).withColumn("hangs", (F.col("rep") == F.col("c_rep")) & (F.col("depth") == F.col("c_depth")))
        split = scratch.stage(deeper.unionByName(level), "split")
        totals = split.where("hangs").groupBy(*key).agg(F.sum("leaves").alias("t_leaves"), F.sum("saved").alias("t_saved"))
        joined = split.join(totals, key)
        on_path = 2 * F.col("weight") > F.col("whole")
        added = lambda s, t: (F.col(s) + F.when(on_path, F.col(t)).otherwise(0)).alias(s)
        centre = (F.col("rep") == F.col("c_rep")) & (F.col("depth") == F.col("c_depth"))
        moved = joined.select(
            "rep", "depth", "parent", "leaves", "saved", centre.alias("centre"),
            F.when(F.col("hangs"), F.col("s_rep")).otherwise(F.col("top")).alias("top"),
            F.when(F.col("hangs"), F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth"),
            (F.col("weight") - F.when(on_path, F.col("c_weight")).otherwise(0)).alias("weight"),
            added("sum_leaves", "t_leaves"), added("sum_saved", "t_saved"),
        )
        moved = scratch.stage(moved, "level")
        done.append(moved.where("centre").select("rep", "depth", "sum_leaves", "sum_saved"))
        state = moved.where("NOT centre").drop("centre")
        if state.isEmpty():
            break
    for rows in small:
        grouped = rows.select(*_STATE, "parent").repartition(*key).sortWithinPartitions(*key, "depth")
        done.append(_finish_small(grouped))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


# Ends


def _hash_ends(ends: DataFrame) -> DataFrame:
    """(rep, depth, ends_sha256): the members that end at a node, ascending, as one hash. Ids are joined in blocks of
    ids that lie together (1,024 at most), and the hash runs over a node's blocks in order, holding one at a time."""
    block = ends.groupBy("rep", "pos", F.shiftright("conv", _ID_BITS).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = block.repartition("rep", "pos").sortWithinPartitions("rep", "pos", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        current, state = None, None
        for batch in batches:
            found: list[tuple[int, int, str]] = []
            for rep, pos, ids in zip(batch.column("rep").to_pylist(), batch.column("pos").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if (rep, pos) != current:
                    if current:
                        found.append((*current, state.hexdigest()))
                    current, state = (rep, pos), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("rep", "depth", "ends_sha256"), f, strict=True)) for f in found], _ENDS)
        if current:
            yield pa.RecordBatch.from_pylist([{"rep": current[0], "depth": current[1], "ends_sha256": state.hexdigest()}], _ENDS)

    return ordered.select("rep", "pos", "ids").mapInArrow(run, "rep long, depth long, ends_sha256 string")


_ENDS = pa.schema([("rep", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
# Fixed value: SHA-256 of the empty string.
NO_ENDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def build_trie(rows: DataFrame, scratch: Scratch, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The nodes of the trie over ``rows`` (conv, pos, h0, h1, chars, length), as ``prefix_trie`` returns them."""
    summed = scratch.stage(prefixes(rows, scratch), "prefixes")
    by = ["pos", *_LANES]
    # Members weigh what they have from here on: a node then weighs its own members more than its children do.
    named = summed.groupBy(*by).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") - F.col("pos") + 1).alias("weight"), F.max("chars").alias("chars")
    )
    named = scratch.stage(named, "named")
    whose = scratch.stage(summed.select("conv", "length", *by).join(named.select(*by, "rep"), by).select("conv", "pos", "length", "rep"), "whose")
    # The prefix one turn shorter of each node's own conversation names its parent.
    nodes = named.select("rep", F.col("pos").alias("depth"), "n_convs", "weight", "chars")
    up = whose.select(F.col("conv").alias("rep"), (F.col("pos") + 1).alias("depth"), F.col("rep").alias("parent"))
    nodes = scratch.stage(nodes.join(up, ["rep", "depth"], "left"), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    full = nodes.join(children, ["rep", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own_saved = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    full = scratch.stage(full.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", own_saved.cast("long")), "valued")
    if full.isEmpty():
        rolled = full.select("rep", "depth", F.col("leaves").alias("sum_leaves"), F.col("saved").alias("sum_saved"))
    else:
        shorter = whose.select("conv", (F.col("pos") + 1).alias("pos"), F.col("rep").alias("parent"))
        steps = scratch.stage(whose.join(shorter, ["conv", "pos"]).select("conv", "pos", "rep", "parent"), "steps")
        rolled = scratch.stage(centroid_rollup(full, steps, scratch, local_nodes), "rolled")
    ends = _hash_ends(whose.where("pos = length").select("rep", "pos", "conv"))
    out = full.join(rolled, ["rep", "depth"]).join(ends, ["rep", "depth"], "left")
    return out.select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rebuild: Callable[[DataFrame, Scratch], DataFrame] = rebuilt,
    local_nodes: int = LOCAL_NODES,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves
    (childless nodes of the subtree), saved_tokens (code points of last texts that all members but one could share, over the
    subtree), ends_sha256 (members of exactly that many turns).

    ``rebuild`` turns the ordered turns (conv, pos, h0, h1, chars) into the sequences of the trie; ``as_they_are`` keeps them.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = turns_in_order(conversations, scratch, conv_col, turn_col, role_col, text_col)
    return scratch.finish(build_trie(rebuild(turns, scratch), scratch, local_nodes))


def as_they_are(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Every conversation with its own turns only."""
    turns = scratch.stage(turns, "turns")
    lengths = scratch.stage(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("length")), "lengths")
    zero = [F.lit(0).cast("long").alias(c) for c in ("pos", "h0", "h1", "chars")]
    return turns.unionByName(lengths.select("conv", *zero)).join(lengths, "conv")
