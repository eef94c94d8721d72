"""The pipeline against plain versions of its stages, one after the other; odd, empty and clashing tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelftide.llm.common import table
from tests.llm import brute

STAGES = dict(corpus_pipeline.STAGES)


def test_like_plain_versions_in_a_row(spark, folder):
    """What the toxicity stage keeps goes through brute force; ids and texts are compared row by row."""
    clean = STAGES["toxicity"](spark, table(spark, folder, "documents"), folder)
    texts = sorted((r["doc_id"], r["text"]) for r in clean.select("doc_id", "text").collect())
    left = brute.left_lines(texts)
    kept = {i: left[i] for i, t in texts if left[i] == t or left[i].split()}
    groups = brute.groups(kept)
    firsts = {i: t for i, t in kept.items() if groups[i] == i}
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    cut = {i: brute.cut_text(t, items) for i, t in firsts.items()}
    want = {i: t for i, (t, share) in cut.items() if share >= 0.5}
    rows = corpus_pipeline.run(spark, folder).select("doc_id", "text", "n_chars", "decoded").collect()
    assert {r["doc_id"]: r["text"] for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) and r["decoded"] == r["text"] for r in rows)
    # Something happened in every stage.
    assert len(texts) > len(kept) > len(firsts) >= len(want) and any(cut[i][0] != firsts[i] for i in want)


@pytest.mark.parametrize("name", STAGES)
def test_stage_on_odd_rows(spark, folder, clashing, tmp_path, name):
    """Columns stay, values too: written and read, so that every column is worked out."""
    out = STAGES[name](spark, clashing, folder)
    out.write.parquet(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.columns[: len(clashing.columns)] == clashing.columns
    assert rows.where(" OR ".join(f"{c} <> 'own {c}'" for c in clashing.columns[5:])).isEmpty()
    # Near copies: one of the texts of ids 4 and 5 stays. Line runs of less than 50 words stay.
    gone = {"near_dedup": {5}}.get(name, set())
    assert {r["doc_id"] for r in rows.collect()} == {None, 1, 2, 3, 4, 5, 6} - gone
    texts = {r["doc_id"]: r["text"] for r in clashing.where("doc_id IS NOT NULL").collect()}
    assert {r["doc_id"]: r["text"] for r in rows.where("doc_id IS NOT NULL AND doc_id <> 3").collect()} == {i: t for i, t in texts.items() if i not in gone | {3}}


@pytest.mark.parametrize("name", STAGES)
def test_stage_without_rows(spark, folder, make_docs, name):
    empty = make_docs([]).withColumn("more", F.lit("x"))
    out = STAGES[name](spark, empty, folder)
    assert out.collect() == [] and out.columns[:6] == empty.columns
