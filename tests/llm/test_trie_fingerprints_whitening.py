"""Prefix trie, term fingerprints and whitening, against plain versions and numpy; odd and empty tables."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelftide.llm import conversation_trie, queries, term_fingerprints, whitening
from shelftide.llm.common import table
from tests.llm import brute

TURNS = "conv_id long, turn long, role string, text string"


def nodes(df, **settings):
    return sorted((tuple(r) for r in conversation_trie.prefix_trie(df, **settings).collect()), key=lambda r: r[:2])


# Trie


@pytest.mark.parametrize("local_nodes", [25, conversation_trie.LOCAL_NODES])
def test_trie_like_plain_walk(spark, folder, local_nodes):
    """With few nodes a task the components are split by joins, level by level."""
    rows = table(spark, folder, "conversations")
    assert nodes(rows, local_nodes=local_nodes) == brute.trie([tuple(r) for r in rows.collect()])


def test_trie_of_deep_wide_and_odd_conversations(spark):
    """One conversation of very many turns and a copy of its beginning, many short ones, nulls, ties, repeated rows."""
    rng = random.Random(1)
    rows = [(c, k, "u", "x" * (k % 3)) for c, n in ((1, 1300), (2, 1100)) for k in range(n)]
    rows += [(c, t, rng.choice("ab"), rng.choice("xyü")) for c in range(5, 140) for t in range(rng.randrange(9))]
    rows += [(None, 1, "a", "b"), (200, None, None, None), (200, None, None, None), (7, 3, "a", "b"), (7, 3, "b", "a"), (7, 3, "b", "a")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("rep", F.lit("own")).withColumn("top", F.lit(1))
    assert nodes(df, local_nodes=60) == brute.trie(rows)


def test_trie_without_rows(spark):
    assert nodes(spark.createDataFrame([], TURNS)) == []
    assert nodes(spark.createDataFrame([(None, 1, "a", "b")], TURNS)) == []


def test_trie_of_conversations_as_they_are(spark):
    rows = [(1, 1, "u", "a"), (1, 2, "v", "bc"), (2, 1, "u", "a"), (3, 1, "w", "a")]
    got = nodes(spark.createDataFrame(rows, TURNS), rebuild=conversation_trie.as_they_are)
    assert [r[:7] for r in got] == [(1, 0, None, 3, 2, 2, 1), (1, 1, 1, 2, 1, 1, 1), (1, 2, 1, 1, 0, 1, 0), (3, 1, 1, 1, 0, 1, 0)]
    assert [r[7] for r in got[1:]] == [hashlib.sha256(e).hexdigest() for e in (b"2", b"1", b"3")]


def test_local_rollup_adds_up_subtrees():
    rng = np.random.default_rng(4)
    parent = np.array([0, *[rng.integers(max(0, k - 4), k) for k in range(1, 400)]])
    depth = np.zeros(400, np.int64)
    for k in range(1, 400):
        depth[k] = depth[parent[k]] + 1
    values, weight, sums = rng.integers(0, 9, (400, 2)), np.ones(400, np.int64), None
    want = values.copy()
    for k in range(399, 0, -1):
        want[parent[k]] += want[k]
        weight[parent[k]] += weight[k]
    sums = conversation_trie._local_rollup(parent, np.zeros(400, np.int64), depth, weight, values)
    assert (sums == want).all()


# Fingerprints


def plain_edit(texts):
    """Edited texts in the order of ids."""
    out = []
    for k, text in enumerate(texts):
        cut = len(text) // 4
        out.append(text[: len(text) - cut] + texts[(k + 1) % len(texts)][:cut])
    return out


def test_edited_texts_and_likeness(spark, folder):
    got = sorted(queries.op12_term_fingerprints(spark, folder).collect(), key=lambda r: r["doc_id"])
    texts = [r["text"] or "" for r in sorted(table(spark, folder, "documents").collect(), key=lambda r: r["doc_id"])]
    assert [r["n_chars"] for r in got] == [len(t) for t in texts]
    assert [r["edited_sha256"] for r in got] == [hashlib.sha256(t.encode()).hexdigest() for t in plain_edit(texts)]
    near, far = [r["near_edited"] for r in got], [r["near_next"] for r in got]
    assert all(0 <= x <= 1 for x in near + far)
    unlike = [a > b for a, b, r in zip(near, far, got, strict=True) if r["n_chars"] >= 40]
    assert sum(unlike) >= 0.95 * len(unlike) and np.mean(near) > 0.3 and np.mean(far) < 0.1
    by_text = {}
    for r, t in zip(got, texts, strict=True):
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        edited = plain_edit(texts)
    for r, t in zip(got, edited, strict=True):
        assert by_text.get(t, r["edited_fingerprint"]) == r["edited_fingerprint"]


def test_lexicon_is_the_band_of_document_frequencies(spark):
    texts = [f"Common all{k} pair{k // 2} four{k // 4}" for k in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    codes = {r["code"] for r in term_fingerprints.lexicon(df, least=0.04, most=0.1).collect()}
    words = [*(f"pair{k}" for k in range(20)), *(f"four{k}" for k in range(10))]
    want = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("c"))
    assert codes == {r["c"] for r in want.collect()}


def test_fingerprint_ignores_order_and_repetition(spark):
    df = spark.createDataFrame([(1, "aa bb cc dd ee"), (2, "EE, dd cc. bb aa aa"), (3, ""), (4, None), (5, "!!"), (6, "aa bb cc dd ff")], "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in term_fingerprints.fingerprint_documents(df).collect()}
    assert got[1] == got[2] and got[3] == got[4] == got[5] and got[1] != got[6] != got[3]


def test_likeness_counts_filled_cells(spark):
    empty = ",".join([""] * (term_fingerprints.CELLS * term_fingerprints.LAYERS))
    first = ["aaaa"] * 8 + [""] * (term_fingerprints.CELLS * term_fingerprints.LAYERS - 8)
    second = ["aaaa"] * 6 + ["bbbb", "", "cccc"] + [""] * (term_fingerprints.CELLS * term_fingerprints.LAYERS - 9)
    pairs = [("x," + empty, "x," + empty), ("x," + empty, "y," + empty), ("x," + ",".join(first), "y," + ",".join(second))]
    rows = spark.createDataFrame(pairs, "a string, b string").select(term_fingerprints.likeness(F.col("a"), F.col("b")).alias("v")).collect()
    assert [r["v"] for r in rows] == [1.0, 0.0, 6 / 9]


def test_odd_fingerprints(clashing):
    out = term_fingerprints.fingerprint_documents(clashing).collect()
    assert len(out) == clashing.count()
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in out)
    assert ids[0] == (False, 0) and len({(r["doc_id"], r["fingerprint"], r["edited_sha256"]) for r in out if r["doc_id"] == 4}) == 1


def test_fingerprints_of_one_and_no_document(spark, make_docs):
    assert term_fingerprints.fingerprint_documents(make_docs([])).collect() == []
    one = term_fingerprints.fingerprint_documents(make_docs([(3, "ab cd ef gh")])).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"ab cd ef ab").hexdigest()


def test_the_lexicon_is_in_no_row(spark, folder):
    """Its subquery stands inside the look-up, not in a column of its own."""
    docs = table(spark, folder, "documents")
    lexicon = term_fingerprints.lexicon_table(term_fingerprints.lexicon(docs))
    both = docs.withColumn("other", F.reverse("text"))
    for name in ("text", "other"):
        both = term_fingerprints.with_fingerprint(both, name, f"{name}_fp", lexicon)
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at(scalar-subquery") == 2 and "_fp_table" not in plan


# Whitening


def plain_whitening(vectors):
    x = np.array([np.floor(256 * np.array(v, float)) for v in vectors]).astype(np.int64)
    once = np.unique(x, axis=0)
    values, axes = np.linalg.eigh(np.cov(once.T.astype(float), bias=True))
    return x, len(once), once.sum(axis=0), values[::-1], axes[:, ::-1]


def test_whitening_like_numpy(spark, folder):
    rows = table(spark, folder, "embeddings").orderBy("vec_id").collect()
    x, n, sums, values, axes = plain_whitening([r["embedding"] for r in rows])
    got = queries.op13_whitening(spark, folder).toPandas()
    assert len(got) == 4 * len(rows) and (got["n"] == n).all() and (got["identity_error"] < 1e-12).all()
    for k in range(4):
        part = got[got["component"] == k + 1].set_index("vec_id").loc[[r["vec_id"] for r in rows]]
        want = (x - sums / n) @ axes[:, k] / math.sqrt(values[k])
        sign = np.sign(part["whitened"].to_numpy() @ want)
        assert np.abs(sign * part["whitened"].to_numpy() - want).max() < 1e-10
        assert np.allclose(part["explained"], values[k] / values.sum(), rtol=1e-12)
        assert (part["deviation"].to_numpy() == ((n * x - sums) ** 2).sum(axis=1)).all()


def test_odd_vectors(spark):
    """Nulls, non-finite and huge entries, other lengths and repeated rows; columns with the names used inside."""
    rng = np.random.default_rng(2)
    good = [(k, [float(v) for v in rng.normal(size=3)]) for k in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, math.nan, 0.0]), (103, [math.inf, 0.0, 0.0]), (104, [1e300, 0.0, 0.0]), (105, [1.0]), (106, [])]
    rows = [*good, good[0], (None, good[1][1]), *odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("own")).withColumn("n", F.lit("own"))
    got = whitening.whiten(df).toPandas()
    assert len(got) == 3 * 32 and (got["n"] == 30).all() and got["identity_error"].max() < 1e-12
    assert got[got["vec_id"] == 0].drop_duplicates().shape[0] == 3


def test_vectors_without_spread(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, [])], kind)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, -0.0]), (2, [0.5, 0.0])], kind)).collect() == []
    line = spark.createDataFrame([(k, [float(k), 2.0 * k]) for k in range(9)], kind)
    got = whitening.whiten(line).collect()
    assert len(got) == 9 and {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_task_sums_in_groups_are_the_same(spark):
    rows = spark.createDataFrame([(k, [float(k % 7), float(k % 5)]) for k in range(500)], "vec_id long, embedding array<float>")
    x = whitening.whole_vectors(rows, "vec_id", "embedding")
    sums = [whitening._task_sums(x.repartition(p), p, 2, lambda m: m.sum(axis=0), (2,), "int64").tolist() for p in (3, 90)]
    assert sums[0] == sums[1] == [256 * sum(k % 7 for k in range(500)), 256 * 1000]


@pytest.mark.parametrize("dim, spectrum", [(12, None), (60, None), (30, "close")])
def test_jacobi_davidson_on_matrices(dim, spectrum):
    rng = np.random.default_rng(dim)
    axes = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    values = np.sort(rng.random(dim))[::-1] if spectrum is None else np.array([5.0, 5.0 - 1e-4, 4.0, *np.linspace(1, 0, dim - 3)])
    matrix = (axes * values) @ axes.T
    found, vectors = whitening.jacobi_davidson(lambda block: matrix @ block, dim, 4)
    assert np.allclose(found, values[:4], rtol=1e-13)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-13 * values[0] * 10


def test_deviations_beyond_64_bits_are_exact_or_null():
    x = np.array([[3, 5], [1 << 40, 7]])
    got = whitening._deviations(x, 1 << 20, np.array([1, 2], object), (1 << 61)).to_pylist()
    assert got == [((3 << 20) - 1) ** 2 + ((5 << 20) - 2) ** 2, None]
