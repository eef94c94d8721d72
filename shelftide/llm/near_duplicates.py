"""Near duplicates by SuperMinHash signatures, banding, verification and union-find.

Words are lower-cased (A-Z) and cut at ASCII white space; a document's set is its distinct
five-word shingles (the whole sequence, if it has fewer words), as 64-bit hashes. Documents are linked
if their sets have a Jaccard similarity of 0.75 or more.

1. SuperMinHash: each element draws one random permutation of the components, and gives the k-th
   of them a value in [k, k+1). The smallest value wins. Components are thus correlated
   (every element touches each once), which lowers the variance, and once all values are
   below k+1 no later rank can win: the loop over ranks stops there.
2. Equal sets are one class, found by a digest of the set; all else is on class representatives.
3. Banding: representatives that share all rows of a band meet in a bucket. Each is compared
   with the smallest of its bucket only, never all with all. A byte of each signature value
   (128 bytes a document) estimates the similarity first; full sets are made and moved only for documents in a pair
   above a floor, whose texts a key filter picks out of the scan.
4. Links confirmed on the full sets go through union-find (in each task, then star
   contraction over tasks). A bucket whose members then have several components is
   compared further, block by block: bytes of the signatures say which members have a partner in
   another component above the floor; only those come again with their sets, and their pairs are
   verified inside the task. So no candidate pair is left out unless both are in one component already.

With 32 bands of 4 rows, a pair at the threshold shares no bucket with probability 5e-6, and the
signature estimate of a linked pair falls below the floor with less than 1e-6.

Defined results: a NULL or wordless text has an empty set, is linked with nothing and stays. Rows
with one doc_id are one document (component ids are doc_ids). Rows without doc_id
are linked with nothing, have no component and stay. Repeated rows have the same component. No rows give no rows. Texts of
any length have their whole set; signatures are taken of 100,000 elements at a time. Other columns are kept by
`drop_near_duplicates`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import Scratch, hash_words, id_and_text, key_filter, lean, map_slices, may_hold, mix, unused_name, window_hashes

SHINGLE = 5
BANDS = 32
ROWS = 4
SIMILARITY_PERCENT = 75
# Least share of equal signature components (of their lowest bytes) for a pair that is compared on full sets.
ESTIMATE_FLOOR = 0.5
# Members of a bucket that are compared with each other in one task.
BLOCK = 500
# Bits of a signature value below its rank.
_FRACTION_BITS = 24


def shingle_sets(texts: list[bytes | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [x.lower().split() if x else [] for x in texts]
    hashes = hash_words([w for words in split for w in words])
    windows = window_hashes(hashes, size)
    out, at = [], 0
    for words in split:
        n = len(words)
        if n >= size:
            out.append(np.unique(windows[at : at + n - size + 1]))
        elif n:
            out.append(window_hashes(hashes[at : at + n], n) ^ np.uint64(n))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """SuperMinHash signatures (one row per set) as integers: rank and fraction in one number.
    An empty set has the largest value everywhere."""
    most = np.iinfo(np.uint32).max
    result = np.full((len(sets), length), most, np.uint32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    flat = result.reshape(-1)
    # Every element's permutation, by swaps from the identity (Fisher-Yates, rank by rank).
    places = np.broadcast_to(np.arange(length, dtype=np.uint8 if length <= 256 else np.uint16), (len(elements), length)).copy()
    row = np.arange(len(elements))
    for rank in range(length):
        draw = mix(elements + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        swap = rank + ((draw & np.uint64(0xFFFFFFFF)) % np.uint64(length - rank)).astype(np.int64)
        chosen = places[row, swap]
        places[row, swap] = places[row, rank]
        value = (np.uint64(rank) << np.uint64(_FRACTION_BITS)) + (draw >> np.uint64(64 - _FRACTION_BITS))
        np.minimum.at(flat, owner * length + chosen, value.astype(np.uint32))
        # A set whose values all lie below the next rank is done.
        open_sets = result.max(axis=1) >= ((rank + 1) << _FRACTION_BITS)
        go_on = open_sets[owner]
        if not go_on.any():
            break
        if not go_on.all():
            owner, elements, places = owner[go_on], elements[go_on], places[go_on]
            row = np.arange(len(elements))
    return result


def _signed_in_parts(sets: list[np.ndarray], length: int, limit: int = 100_000) -> np.ndarray:
    """Signatures of ``limit`` elements at a time, since each element holds its permutation. The
    signature of a set is the minimum of those of its parts."""
    parts = [(k, s[i : i + limit]) for k, s in enumerate(sets) for i in range(0, max(len(s), 1), limit)]
    result = np.full((len(sets), length), np.iinfo(np.uint32).max, np.uint32)
    start, total = 0, 0
    for at, (_, part) in enumerate(parts):
        total += len(part)
        if total >= limit or at + 1 == len(parts):
            taken = parts[start : at + 1]
            np.minimum.at(result, [k for k, _ in taken], signatures([p for _, p in taken], length))
            start, total = at + 1, 0
    return result


_SIGNED = "doc_id long, n_shingles long, set_high long, set_low long, signature binary, sketch binary"


def _sign(docs: DataFrame, length: int) -> DataFrame:
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(part.column("data").to_pylist())
        signed = _signed_in_parts(sets, length)
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        signed_64 = lambda x: x - (1 << 64) if x >= 1 << 63 else x
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signed_64(d >> 64) for d in digests], pa.int64()),
                pa.array([signed_64(d & (1 << 64) - 1) for d in digests], pa.int64()),
                pa.array([s.tobytes() for s in signed], pa.binary()),
                pa.array([s.tobytes() for s in signed.astype(np.uint8)], pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_high", "set_low", "signature", "sketch"],
        )

    return map_slices(docs, work, _SIGNED)


def _sets_of(docs: DataFrame) -> DataFrame:
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        # Sorted as signed numbers, since that is how the column reads them.
        sets = [np.sort(s.view(np.int64)) for s in shingle_sets(part.column("data").to_pylist())]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate(sets) if sets else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["node", "shingles"]
        )

    return map_slices(docs, work, "node long, shingles array<long>")


# Connected components


def _local_forest(links: DataFrame) -> DataFrame:
    """Union-find over the links of each task: (u, v) with v the root of u, v < u."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(up, up)
            return x

        for batch in batches:
            for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["u", "v"]
        )

    return links.mapInArrow(lean(unite), "u long, v long")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node with a link (u, v); the component is its smallest node.

    Each round hangs every node on the smallest neighbour of each neighbour that is smaller than it, contracts by
    union-find inside the tasks, and again where all neighbours of a node meet (alternating stars). A task
    then knows one parent of a node at most, so a node with very many neighbours sends a row a task. When every node has
    one parent, parents are replaced by their own until none has one. Links never become more.
    """
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = scratch.stage(_local_forest(_local_forest(pairs).repartition("u")), "links")
    while True:
        parents = scratch.stage(edges.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("last")), "parents")
        if parents.where("v < last").isEmpty():
            break
        hung = _local_forest(_hung_higher(edges, parents).select("u", "v"))
        edges = scratch.stage(_local_forest(hung.repartition("u")), "links")
    # The first pass shows whether a parent has a parent at all.
    while True:
        higher = scratch.stage(_hung_higher(parents, parents), "parents")
        if higher.where("moved").isEmpty():
            return higher.select(F.col("u").alias("node"), F.col("v").alias("component"))
        parents = higher


def _hung_higher(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """(u, v) with the parent of v in place of v where it has one (``moved``). Both sides are staged, so
    the join shuffles them itself and a parent of very many nodes can be split there."""
    above = parents.select(F.col("u").alias("v"), F.col("v").alias("above"))
    return edges.select("u", "v").join(above, "v", "left").select("u", F.coalesce("above", "v").alias("v"), F.col("above").isNotNull().alias("moved"))


# Candidates and their verification


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    # A pivot of very many pairs is a skewed key of the first join; each pair is alone in the second.
    both = pairs.join(right, "v").join(left, "u")
    common = F.size(F.array_intersect("su", "sv")).cast("long")
    counted = both.select("u", "v", common.alias("common"), (F.size("su") + F.size("sv")).cast("long").alias("total"))
    return counted.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("u", "v")


def _alike(pairs: DataFrame, nodes: DataFrame, length: int, floor: float) -> DataFrame:
    """The pairs (u, v) whose sketches agree in a share of ``floor`` or more; one of a node with several sets may repeat."""
    left, right = (nodes.select(F.col("node").alias(n), F.col("sketch").alias(f"sketch_{n}")) for n in "uv")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(f"sketch_{n}").to_pylist()), np.uint8).reshape(-1, length) for n in "uv")
            fits = pa.array((one == two).sum(axis=1) >= floor * length)
            yield batch.select(["u", "v"]).filter(fits)

    # A pivot of very many pairs is a skewed key of the first join; each pair is alone in the second.
    return pairs.join(right, "v").join(left, "u").mapInArrow(lean(work), "u long, v long")


def _dealt(members: DataFrame, columns: list[str]) -> DataFrame:
    """Members of large buckets in blocks, every two blocks of a bucket in a group of their own."""
    return (
        members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component", *columns)
    )


def _signed(block: pa.Table, bands: int, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(block.column("signature").to_pylist()), np.uint32).reshape(block.num_rows, bands, rows)


def _candidates(block: pa.Table, signed: np.ndarray, floor: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of the lower block the rows of the other one that are in another component, first meet it
    in this band, and agree with it in a share of ``floor`` of ``signed`` (rows x bands x rows of a band)."""
    node, component, own = (block.column(c).to_numpy() for c in ("node", "component", "own"))
    low, high, band = (block.column(c)[0].as_py() for c in ("low", "high", "band"))
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    for k in left:
        others = right if low != high else right[right > k]
        others = others[(component[others] != component[k]) & (node[others] != node[k])]
        if len(others):
            equal = signed[others] == signed[k]
            first_here = equal.all(axis=2).argmax(axis=1) == band
            others = others[first_here & (equal.mean(axis=(1, 2)) >= floor)]
        if len(others):
            yield k, others


def _open_members(members: DataFrame, bands: int, rows: int, floor: float) -> DataFrame:
    """(bucket, low, high, node), each once: members of a bucket that have a candidate partner in the blocks of that group.

    ``members``: bucket, band, node, component, blocks, signature. A task holds the signatures of two blocks at most."""

    def look(block: pa.Table) -> pa.Table:
        found: set[int] = set()
        for k, others in _candidates(block, _signed(block, bands, rows), floor):
            found.add(int(k))
            found.update(others.tolist())
        # A node of several sets has several rows.
        rows_of = dict(zip(block.column("node").take(pa.array(sorted(found), pa.int64())).to_pylist(), sorted(found), strict=True))
        return block.select(["bucket", "low", "high", "node"]).take(pa.array(sorted(rows_of.values()), pa.int64()))

    return _dealt(members, ["signature"]).groupBy("bucket", "low", "high").applyInArrow(look, "bucket long, low int, high int, node long")


def _links_in_blocks(members: DataFrame, bands: int, rows: int, percent: int, floor: float) -> DataFrame:
    """Components (u, v) of one bucket with a confirmed link between their members.

    ``members``: bucket, low, high, band, own, node, component, signature, shingles, the members with a candidate partner. A
    pair is confirmed on the full sets in the task, so no unconfirmed pair becomes a row.
    """

    def compare(block: pa.Table) -> pa.Table:
        component, held = block.column("component").to_numpy(), block.column("shingles").combine_chunks()
        ends = np.asarray(held.offsets)
        values = np.asarray(held.values)
        sets = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        sizes = np.diff(ends)
        found: set[tuple[int, int]] = set()
        for k, others in _candidates(block, _signed(block, bands, rows), floor):
            # Sizes alone rule out a pair whose smaller set is too small a part of the larger one.
            others = others[100 * np.minimum(sizes[others], sizes[k]) >= percent * np.maximum(sizes[others], sizes[k])]
            if not len(others):
                continue
            mine = sets[k]
            flat = np.concatenate([sets[x] for x in others])
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            common = np.add.reduceat(mine[at] == flat, np.concatenate([[0], np.cumsum(sizes[others])[:-1]]), dtype=np.int64)
            linked = others[100 * common >= percent * (sizes[others] + sizes[k] - common)]
            mine_is = int(component[k])
            found.update((max(mine_is, x), min(mine_is, x)) for x in np.unique(component[linked]).tolist())
        pairs = sorted(found)
        return pa.table({n: pa.array([p[i] for p in pairs], pa.int64()) for i, n in enumerate("uv")})

    return members.groupBy("bucket", "low", "high").applyInArrow(compare, "u long, v long")


def _sets_for(needed: DataFrame, source: DataFrame, several: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, shingles) of the documents in ``needed`` (doc_id). A key filter picks their texts out of the scan, so the
    others are not shuffled to find out. Only ids of several rows can repeat a set; they alone are kept once."""
    passes = scratch.stage(key_filter(needed.select(F.xxhash64("doc_id").alias("code"))), "filter")
    texts = source.where(may_hold(passes, F.xxhash64("doc_id"))).join(needed, "doc_id", "left_semi")
    tagged = texts.join(several.withColumn("several", F.lit(True)), "doc_id", "left").select(F.col("doc_id"), "data", F.coalesce("several", F.lit(False)).alias("several"))
    tagged = scratch.stage(tagged, "texts")
    alone = _sets_of(tagged.where("NOT several").select("doc_id", "data"))
    repeated = _sets_of(tagged.where("several").select("doc_id", "data"))
    repeated = repeated.withColumn("digest", F.xxhash64("shingles")).dropDuplicates(["node", "digest"]).drop("digest")
    sets = scratch.stage(alone.unionByName(repeated), "sets")
    scratch.drop(tagged, passes)
    return sets


def find_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (it is the smallest)."""
    length, scratch = bands * rows, Scratch(docs.sparkSession, "near_duplicates")
    source = id_and_text(docs, id_col, text_col)
    signed = scratch.stage(_sign(source, length), "signatures")
    linked = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sets have equal signatures, so a class takes those of any member.
    own = [F.min("doc_id").alias("node"), F.first("signature").alias("signature"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("n")]
    nodes = scratch.stage(linked.groupBy("set_high", "set_low").agg(*own), "classes")
    # Members hang on their class, so rows that share a doc_id, which is one document, link their classes.
    shared_sets = nodes.where("n > 1").select("set_high", "set_low", "node")
    same_set = linked.select("doc_id", "set_high", "set_low").join(shared_sets, ["set_high", "set_low"])
    same_set = same_set.where("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    several = scratch.stage(linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "several")

    width = 4 * rows
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", 1 + b * width, width)) for b in range(bands)])
    placed = nodes.select("node", F.posexplode(keys).alias("band", "bucket"))
    pivots = placed.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"))
    pivots = scratch.stage(pivots.where("pivot <> last").select("bucket", "pivot", "size"), "buckets")
    shared = scratch.stage(placed.join(pivots, "bucket").select("bucket", "band", "node", "pivot", "size"), "bucketed")
    first = shared.where("node <> pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    first = scratch.stage(_alike(first, nodes, length, ESTIMATE_FLOOR), "pairs")
    needed = scratch.stage(first.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), "needed")
    sets = _sets_for(needed, source, several, scratch)
    links = scratch.stage(_verified(first, sets, percent), "confirmed")
    scratch.drop(sets, needed)

    found = components(links.unionByName(same_set), scratch)
    # Pairs with the pivot are decided; what may be open is among three members or more.
    labelled = shared.where("size > 2").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = scratch.stage(labelled.select("bucket", "band", "node", "component"), "labelled")
    scratch.drop(shared)
    mixed = labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
    mixed = mixed.where("a <> b").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    mixed = scratch.stage(mixed, "mixed")
    rest = scratch.stage(labelled.join(mixed, "bucket"), "rest")
    signature = nodes.select("node", "signature")
    still_open = scratch.stage(_open_members(rest.join(signature, "node"), bands, rows, ESTIMATE_FLOOR), "open")
    needed = scratch.stage(still_open.select(F.col("node").alias("doc_id")).distinct(), "needed")
    sets = _sets_for(needed, source, several, scratch)
    again = _dealt(rest, []).join(still_open, ["bucket", "low", "high", "node"])
    # Signature and set come together once for a document, not once for every group that it is in.
    described = scratch.stage(sets.join(signature, "node"), "described")
    # Staged, since a task that compares and unites in one stage has two Python workers.
    more = scratch.stage(_links_in_blocks(again.join(described, "node"), bands, rows, percent, ESTIMATE_FLOOR), "more")
    # Only components are linked any more, not documents.
    merged = components(more, scratch).withColumnRenamed("node", "first_component").withColumnRenamed("component", "merged")
    final = found.withColumnsRenamed({"node": "doc_id", "component": "first_component"})
    joined = signed.select("doc_id", "n_shingles").join(final, "doc_id", "left")
    # A document without a link yet may be linked now.
    joined = joined.withColumn("first_component", F.coalesce("first_component", "doc_id")).join(merged, "first_component", "left")
    component = F.coalesce("merged", "first_component")
    kept = F.col("doc_id").isNull() | (component == F.col("doc_id"))
    result = joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(kept, F.lit(True)).alias("kept"))
    return scratch.finish(result)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """The smallest document of each group, and documents without a group; all columns kept.
    Of rows that repeat a doc_id all stay or all go."""
    groups = find_groups(docs, id_col, text_col, **settings)
    key = unused_name(docs.columns, "gone_id")
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col(key), "left_anti")
