"""Results that must not depend on blocks, filters or the order of rows; hostile texts; name clashes."""

from __future__ import annotations

import itertools
import random
import re
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelftide.llm import common, decontamination, labelled_sample, line_runs, near_duplicates, pii_pseudonyms
from tests.llm import brute


def test_key_filter_lets_all_its_keys_pass(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("code"))
    held = common.key_filter(rows.where("abs(code) % 3 = 0"))
    got = rows.select((F.abs("code") % 3 == 0).alias("inside"), common.may_hold(held, F.col("code")).alias("passes")).collect()
    assert all(r["passes"] for r in got if r["inside"])
    assert sum(r["passes"] for r in got if not r["inside"]) < 20
    nothing = common.key_filter(rows.where("false"))
    assert rows.where(common.may_hold(nothing, F.col("code"))).isEmpty()


def plain_cut(words, items, size=10):
    """Words left, with a mark for each cut; rounds of all windows of all items."""
    windows = {tuple(i[k : k + min(size, len(i))]) for i in items if i for k in range(len(i) - min(size, len(i)) + 1)}
    while True:
        here = [w for w in words if w != "\n"]
        hit = {p for w in windows for k in range(len(here) - len(w) + 1) if tuple(here[k : k + len(w)]) == w for p in range(k, k + len(w))}
        if not hit:
            return here
        words = [w for k, w in enumerate(here) if k not in hit]


def test_cuts_do_not_depend_on_blocks(spark, make_docs):
    """Words of other items that a cut brings together are cut as well, whichever block holds them."""
    items = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "m n"), (4, "n m")], "item_id bigint, text string")
    docs = make_docs([(1, "k1 k2 k3 k4 k5 k6 k7 d a b c e f k8 k9"), (2, "k m m n n k k k k k"), (3, "clean text"), (4, None), (1, "a b c x y z u v w")])
    results = [sorted(map(tuple, decontamination.decontaminate(docs, items, block_bytes=b).collect()), key=repr) for b in (1 << 20, 20, 2)]
    assert results[0] == results[1] == results[2]
    texts = {r[0]: r[1] for r in results[0] if r[1] and r[1].startswith("k1")}
    assert texts[1].split() == "k1 k2 k3 k4 k5 k6 k7 k8 k9".split()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=14), min_size=1, max_size=5), st.lists(st.lists(st.sampled_from("abcd"), max_size=3), min_size=1, max_size=4))
def test_any_cut_is_the_plain_one(spark, make_docs, texts, items):
    held = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id bigint, text string")
    docs = make_docs([(k, " ".join(t)) for k, t in enumerate(texts)])
    for size in (1 << 20, 2):
        got = {r["doc_id"]: r["text"].split() for r in decontamination.decontaminate(docs, held, max_hit_share=1.0, block_bytes=size).collect()}
        assert got == {k: plain_cut(t, items) for k, t in enumerate(texts)}


def test_a_count_column_replaces_one_of_its_name(make_docs):
    docs = make_docs([(1, "mail a.b@c.de"), (2, None)]).withColumn("n", F.lit("own")).withColumn("N_Lines", F.lit("own"))
    out = pii_pseudonyms.pseudonymise(docs, count_col="n")
    assert out.columns.count("n") == 1 and {r["doc_id"]: r["n"] for r in out.collect()} == {1: 1, 2: 0}
    left = line_runs.delete_repeated_runs(docs, counts=("n_lines", "n_deleted"))
    assert [c.lower() for c in left.columns].count("n_lines") == 1
    assert {r["doc_id"]: (r["n_lines"], r["n_deleted"]) for r in left.select("doc_id", "n_lines", "n_deleted").collect()} == {1: (1, 0), 2: (0, 0)}


def test_contradicting_labels_are_the_same_in_any_order(spark):
    rows = [(1, 0), (1, 1), (2, 0), (2, None), (None, 1)]
    for order in (rows, rows[::-1]):
        got = labelled_sample.sample_ids(spark.createDataFrame(order, "doc_id long, label int"), "doc_id", 10, ["label"]).collect()
        assert sorted(map(tuple, got)) == [(1, 1), (2, 0)]


def test_lines_without_and_with_copies(make_docs):
    """Texts that nothing is deleted from do not pass through the cutter; both ways give the counts of plain Python."""
    run = "\n".join(" ".join(f"w{k}_{j}" for j in range(20)) for k in range(4))
    texts = {1: run, 2: "x\n" + run + "\ny", 3: None, 4: "", 5: "one\ntwo\n", 6: run}
    out = line_runs.delete_repeated_runs(make_docs(list(texts.items())), counts=("n_lines", "n_deleted"))
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_deleted"]) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == brute.left_lines(sorted(texts.items()))
    assert {k: v[1:] for k, v in got.items()} == {1: (4, 0), 2: (6, 4), 3: (0, 0), 4: (1, 0), 5: (3, 0), 6: (4, 4)}


def test_open_members_of_a_bucket_are_all_compared(make_docs, monkeypatch):
    """Blocks of a few members: near copies that the pivot does not link are still found."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 7)
    rng = random.Random(9)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for k in range(70):
        words = list(base)
        for at in rng.sample(range(120), 2 + k % 5):
            words[at] = f"x{k // 2}_{at}"
        rows.append((k, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.find_groups(make_docs(rows)).collect()}
    assert got == brute.groups(dict(rows))


# Personal data


HOSTILE = ["x@a" + ".a" * 100_000 + ".com", "a" * 300_000 + "@b.de", "1-" * 200_000, "+1" + " 22" * 100_000, "DE" + "1" * 300_000, "@" * 200_000, "GB82 " * 60_000, "1." * 200_000]


@pytest.mark.parametrize("k", range(len(HOSTILE)))
def test_hostile_texts_pass(spark, make_docs, tmp_path, k):
    pii_pseudonyms.pseudonymise(make_docs([(1, HOSTILE[k]), (2, "a.b@c.de")]), count_col="n").write.parquet(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).where("doc_id = 2").first()["n"] == 1


def remainder(account):
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97


def test_accounts_and_social_security_numbers(make_docs):
    text = "123-45-6789 000-12-3456 666-12-3456 900-12-3456 667-01-0001; DE89370400440532013000 GB82 WEST 1234 5698 7654 32 DE89370400440532013001 FR14 2004 1010 0505 0001 3M02 606."
    docs = make_docs([(1, text), (2, text)])
    out = pii_pseudonyms.pseudonymise(docs, count_col="n")
    one, two = (r["text"] for r in sorted(out.collect(), key=lambda r: r["doc_id"]))
    assert one == two and {r["n"] for r in out.collect()} == {5}
    kept = ("000-12-3456", "666-12-3456", "900-12-3456", "DE89370400440532013001")
    assert all(v in one for v in kept) and not any(v in one for v in ("123-45-6789", "667-01-0001", "DE89370400440532013000", "GB82 WEST"))
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
    assert shape(one) == shape(text)
    accounts = re.findall(r"(?:DE|GB|FR)[0-9]{2}[0-9A-Z ]+[0-9A-Z]", one.split(";")[1])
    found = [a for part in accounts for a in re.split(r" (?=(?:DE|GB|FR)[0-9]{2})", part)]
    assert sorted(remainder(a.replace(" ", "")) for a in found)[:3] == [1, 1, 1]
    numbers = [tuple(map(int, m)) for m in re.findall(r"\b([0-9]{3})-([0-9]{2})-([0-9]{4})\b", one.split(";")[0])]
    moved = [n for n in numbers if "%03d-%02d-%04d" % n not in kept]
    assert len(moved) == 2 and all(0 < a < 900 and a != 666 and g and s for a, g, s in moved)
    back = {r["doc_id"]: r["text"] for r in pii_pseudonyms.pseudonymise(out.drop("n"), forward=False).collect()}
    assert back == {1: text, 2: text}


def test_a_worker_keeps_one_store_until_another_operator_comes():
    made = []
    first = common.held_by_worker("a", lambda: made.append("a") or "store a")
    assert common.held_by_worker("a", lambda: made.append("again")) is first and made == ["a"]
    assert common.held_by_worker("b", lambda: "store b") == "store b" and list(common._HELD) == ["b"]
    common.release_held()
    assert not common._HELD
    batch = pa.RecordBatch.from_pydict({"data": [b"x"]})

    class Frame:
        def mapInArrow(self, run, schema):
            common.held_by_worker("codec", lambda: "words")
            return list(run(iter([batch]))), list(common._HELD)

    assert common.map_slices(Frame(), lambda b: b, "data binary") == ([batch], [])
    assert common.map_slices(Frame(), lambda b: b, "data binary", keeps=True) == ([batch], ["codec"])
    common.release_held()


def _components_of(spark, pairs):
    from shelftide.llm.common import Scratch
    from shelftide.llm.near_duplicates import components

    scratch = Scratch(spark, "components")
    got = components(spark.createDataFrame(pairs, "u bigint, v bigint").repartition(5), scratch)
    rows = got.collect()
    assert len({r["node"] for r in rows}) == len(rows)
    return {r["node"]: r["component"] for r in rows}, scratch


def test_flat_links_need_no_round(spark):
    """A group around its smallest member is staged three times: links, parents, parents of parents."""
    got, scratch = _components_of(spark, [(k, 1) for k in range(2, 40)])
    assert got == dict.fromkeys(range(2, 40), 1)
    assert len(scratch.held) <= 3


def test_components_of_chains_hubs_and_random_links(spark):
    rng = random.Random(9)
    numbers = rng.sample(range(1000, 2000), 120)
    chain = list(itertools.pairwise(numbers[:60]))
    hub = [(9999, x) for x in numbers[60:90]]  # the largest is in the middle
    loose = [(rng.choice(numbers[90:]), rng.choice(numbers[90:])) for _ in range(25)]
    pairs = chain + hub + loose + loose
    want = {}
    for a, b in pairs:
        both = want.get(a, {a}) | want.get(b, {b})
        want.update(dict.fromkeys(both, both))
    want = {x: min(group) for x, group in want.items()}
    got, _ = _components_of(spark, pairs)
    assert got == {x: least for x, least in want.items() if x != least}


def test_links_of_blocks_are_staged_before_they_are_united(spark, make_docs, monkeypatch):
    """A task that compares members and unites their links would have two Python workers at once."""
    plans, united = [], near_duplicates.components

    def seen(links, scratch):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return united(links, scratch)

    monkeypatch.setattr(near_duplicates, "components", seen)
    words = [f"w{i}" for i in range(40)]
    docs = make_docs([(i, " ".join([*words[: 40 - i], f"x{i}"])) for i in range(8)])
    assert near_duplicates.find_groups(docs).count() == 8
    assert len(plans) == 2 and not [p for p in plans if "InArrow" in p]


_HELD_AFTER_TASK = r"""
import re, random
import pyarrow as pa
from shelftide.llm import near_duplicates

def held():
    return sum(map(int, re.findall(r"\nPss_(?:Anon|Shmem):\s+(\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

class Frame:
    def mapInArrow(self, run, schema):
        return run

def rows(n):
    made = random.Random(n)
    words = ["%x" % made.getrandbits(30) for _ in range(5000)]
    texts = [" ".join(made.choices(words, k=500)).encode() for _ in range(n)]
    yield pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "data": texts})

task = near_duplicates._sign(Frame(), 128)
assert sum(b.num_rows for b in task(rows(10))) == 10
before = held()
assert sum(b.num_rows for b in task(rows(6000))) == 6000
print(held() - before)
"""


def test_a_finished_task_gives_its_memory_back():
    """MB that a process keeps after a task over 24 MB of text."""
    rollup = Path("/proc/self/smaps_rollup")
    if not rollup.exists():
        pytest.skip("memory can't be read here")
    done = subprocess.run([sys.executable, "-c", _HELD_AFTER_TASK], capture_output=True, text=True, cwd=Path(__file__).parents[2], check=True)
    assert float(done.stdout) < 30
