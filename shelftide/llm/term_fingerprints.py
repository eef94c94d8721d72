"""Document fingerprints by I-Match with randomised lexicons, in DataFrame functions only.

Terms are the lower-cased runs of letters and digits of a text. The lexicon holds the terms whose inverse document
frequency lies in a band: terms of more than ``most`` of all documents say nothing, terms of fewer than
``least`` of them (and of fewer than two) do not last. Document frequencies are counted over all documents.

A document's lexicon terms are made distinct and sorted, and hashed over several randomised subsets of the lexicon:
``LAYERS`` random samples of it (the whole, a quarter, a sixteenth, a sixty-fourth), each dealt into ``CELLS`` random
cells. Each cell is a lexicon of its own and gives one 16-bit hash of the document's sorted terms in it, or
nothing if it has none there. The hash over all lexicon terms comes first. An edit breaks only the cells
whose terms it touches; long documents keep cells in the thin samples, short ones in the full one.

The likeness of two fingerprints is 1 if they are equal; else it is taken in the thinnest sample in which at least half of
the cells are filled on either side (the full one, if none is): the share of equal cells among the
filled ones. Two fingerprints without any cell are 1 alike if equal, else 0.

The lexicon reaches the tasks as a table of buckets of 64-bit hashes. Its size is bounded without regard to the number of
documents: a document of m distinct terms adds m to the frequencies, so at most (mean m) / ``least`` terms have
a share of ``least``; 2,000 times the mean here. What moves between tasks: each distinct term once per task for
the counts; each text twice, to hand its beginning to the one before it and to meet that of the one after it (a quarter of
the texts); and the fingerprints.

Defined results: a NULL text is an empty one. Documents go by id (NULL first), equal ids by a hash of the text; rows that
repeat id and text are one document and get the same values. A text of fewer than ``FEWEST`` lexicon terms is known by
all its terms (a large group of near copies has no others), one without terms by the hash of nothing. The document
after the last is the first; a single document is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelftide.llm.common import Scratch

# Shares of all documents that a lexicon term is in.
LEAST, MOST = 0.0005, 0.05
CELLS = 32
# Each further sample of the lexicon holds a quarter of the one before.
LAYERS = 4
_SHARE_BITS = 2
# Lexicon terms that a text needs to be known by them alone.
FEWEST = 4
# Buckets of the lexicon's table.
BUCKETS = 1 << 14
_NO_ID = -(1 << 63)


def terms(text: Column) -> Column:
    """The distinct lower-cased runs of letters and digits, in the order of their first places."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), "")


def _bucket(code: Column) -> Column:
    return (F.shiftrightunsigned(code, 40).bitwiseAND(F.lit(BUCKETS - 1)) + 1).cast("int")


def lexicon(texts: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """(code): 64-bit hashes of the terms of column ``text`` whose document frequency is inside the band."""
    counted = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy(F.xxhash64("term").alias("code")).agg(F.count(F.lit(1)).alias("df"))
    documents = texts.agg(F.count(F.lit(1)).alias("documents"))
    total = documents.scalar()
    return counted.where((F.col("df") >= 2) & (F.col("df") >= total * least) & (F.col("df") <= F.greatest(total * most, F.lit(2)))).select("code")


def lexicon_table(codes: DataFrame) -> DataFrame:
    """One row ``buckets``: for every bucket the array of its hashes. Bounded as the lexicon is."""
    empty = codes.sparkSession.range(1, BUCKETS + 1).select(F.col("id").cast("int").alias("at"), F.lit(None).cast("long").alias("code"))
    filled = codes.select(_bucket(F.col("code")).alias("at"), "code").unionByName(empty)
    each = filled.groupBy("at").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    return each.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "codes"))), lambda b: b["codes"]).alias("buckets"))


def with_fingerprint(rows: DataFrame, text_col: str, out_col: str, table: DataFrame) -> DataFrame:
    """``rows`` with the fingerprint of ``text_col``: eight hex digits for all terms, then four for every cell or
    nothing, sample by sample, with commas between.

    ``table`` is the lexicon's one row. It is a scalar subquery in a column that one expression uses, so the optimizer puts it
    in that expression's place and no row ever holds it. The terms of a cell stand together once they are sorted, and one
    pass over them folds each cell to its hash."""
    kept, base, held = (f"{out_col}_{c}" for c in ("kept", "base", "table"))
    codes = F.transform(terms(F.col(text_col)), lambda t: F.xxhash64(t))
    out = rows.withColumn(held, table.scalar())
    out = out.withColumn(kept, F.filter(codes, lambda c: F.array_contains(F.element_at(F.col(held), _bucket(c)), c)))
    # Texts of hardly any lexicon terms are known by all their terms; only for them are the terms taken again.
    out = out.withColumn(base, F.array_sort(F.when(F.size(kept) >= FEWEST, F.col(kept)).otherwise(codes)))
    return out.withColumn(out_col, F.concat_ws(",", _short(F.xxhash64(base), 8), *[_cells(F.col(base), layer) for layer in range(LAYERS)])).drop(kept, base, held)


def _short(code: Column, digits: int = 4) -> Column:
    return F.substring(F.lpad(F.lower(F.hex(code)), 16, "0"), 17 - digits, digits)


def _cells(codes: Column, layer: int) -> Column:
    """The hashes of the sample's cells, with commas between; ``codes`` are sorted."""
    # Other bits of the mixed code sample the lexicon than deal the cells.
    mixed = lambda c: F.xxhash64(c, F.lit(layer))
    share = F.lit((1 << (_SHARE_BITS * layer)) - 1)
    sampled = F.filter(codes, lambda c: F.shiftrightunsigned(mixed(c), 20).bitwiseAND(share) == 0) if layer else codes
    placed = F.array_sort(F.transform(sampled, lambda c: F.struct(mixed(c).bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("cell"), c.alias("code"))))
    start = F.struct(F.lit(-1).alias("cell"), F.lit(0).cast("long").alias("hash"), F.lit("").alias("out"))

    def closed(s: Column, upto: Column) -> Column:
        """What is written so far, with the open cell and the empty ones before ``upto``."""
        own = F.when(s["cell"] >= 0, F.concat(s["out"], _short(s["hash"]))).otherwise(s["out"])
        return F.concat(own, F.repeat(F.lit(","), upto - F.greatest(s["cell"], F.lit(0))))

    def step(s: Column, t: Column) -> Column:
        same = t["cell"] == s["cell"]
        return F.struct(
            t["cell"].alias("cell"),
            F.when(same, F.xxhash64(s["hash"], t["code"])).otherwise(F.xxhash64(t["code"])).alias("hash"),
            F.when(same, s["out"]).otherwise(closed(s, t["cell"])).alias("out"),
        )

    return F.aggregate(placed, start, step, lambda s: closed(s, F.lit(CELLS - 1)))


def likeness(a: Column, b: Column) -> Column:
    """The likeness of two fingerprints, from 0 to 1."""
    x, y = F.split(a, ","), F.split(b, ",")
    shares, fits = [], []
    for layer in range(LAYERS):
        cut = lambda parts, layer=layer: F.slice(parts, 2 + layer * CELLS, CELLS)
        both = F.zip_with(cut(x), cut(y), lambda p, q: F.when((p == "") & (q == ""), 0).when(p == q, 1).otherwise(-1))
        filled = F.size(F.filter(both, lambda v: v != 0))
        shares.append(F.try_divide(F.size(F.filter(both, lambda v: v == 1)), filled))
        fits.append(2 * filled >= CELLS)
    found = F.coalesce(*[F.when(fit, share) for fit, share in reversed(list(zip(fits, shares, strict=True)))], shares[0], F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(found).cast("double")


def _in_order(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """(k, tie, need, next_k, next_tie) for every key: how many code points of the next document's text it takes over, and
    which that is. Ranges of the sorted keys are numbered apart; a table of one row per range shifts them."""
    ranged = keys.repartitionByRange("k", "tie").sortWithinPartitions("k", "tie")
    placed = scratch.stage(ranged.withColumn("part", F.spark_partition_id()).withColumn("mark", F.monotonically_increasing_id()), "keys")
    parts = placed.groupBy("part").agg(F.min("mark").alias("start"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per range of the sort, however many documents there are.
    shifts = parts.select("part", (before - F.col("start")).alias("shift"))
    total = parts.agg(F.sum("n")).scalar()
    numbered = placed.join(F.broadcast(shifts), "part").select("k", "tie", "n_chars", (F.col("mark") + F.col("shift")).alias("at"))
    numbered = scratch.stage(numbered, "numbered")
    following = numbered.select(F.col("k").alias("next_k"), F.col("tie").alias("next_tie"), F.pmod(F.col("at") - 1, total).alias("at"))
    need = F.floor(F.col("n_chars") / 4).alias("need")
    return scratch.stage(numbered.join(following, "at").select("k", "tie", need, "next_k", "next_tie"), "following")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last n_chars / 4 code points replaced by as many from the beginning of the next document."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("k"), text.alias("text"))
    rows = rows.select("k", F.xxhash64("text").alias("tie"), "text")
    keys = rows.groupBy("k", "tie").agg(F.max(F.length("text").cast("long")).alias("n_chars"))
    following = _in_order(keys, scratch)
    table = scratch.stage(lexicon_table(scratch.stage(lexicon(rows, least, most), "lexicon")), "table")

    # What each document hands to the one before it.
    given = following.select(F.col("next_k").alias("k"), F.col("next_tie").alias("tie"), F.col("k").alias("to_k"), F.col("tie").alias("to_tie"), "need")
    heads = rows.join(given, ["k", "tie"]).select(
        F.col("to_k").alias("k"), F.col("to_tie").alias("tie"), F.col("k").alias("next_k"), F.col("tie").alias("next_tie"), "need",
        F.substring("text", F.lit(1), F.col("need").cast("int")).alias("head"),
    )
    # Rows that repeat id and text hand over the same beginning: one is enough.
    heads = heads.groupBy("k", "tie").agg(*[F.first(c).alias(c) for c in ("next_k", "next_tie", "need", "head")])
    edited = F.concat(F.substring("text", F.lit(1), (F.length("text") - F.col("need")).cast("int")), F.col("head"))
    joined = rows.join(heads, ["k", "tie"]).select("k", "tie", "next_k", "next_tie", "text", edited.alias("edited"))
    printed = with_fingerprint(with_fingerprint(joined, "text", "fingerprint", table), "edited", "edited_fingerprint", table)
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    printed = printed.select("k", "tie", "next_k", "next_tie", F.length("text").cast("long").alias("n_chars"), digest, "fingerprint", "edited_fingerprint")
    printed = scratch.stage(printed, "printed")
    after = printed.select(F.col("k").alias("next_k"), F.col("tie").alias("next_tie"), F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["next_k", "next_tie"])
    result = printed.join(after, ["next_k", "next_tie"]).select(
        F.when(F.col("k") == _NO_ID, None).otherwise(F.col("k")).alias("doc_id"),
        "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
    return scratch.finish(result)
