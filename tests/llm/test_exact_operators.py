"""Operators with an exact answer, against brute force and the libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from shelftide.llm import decontamination, fertility, labelled_sample, line_runs, near_duplicates, piece_codec, queries, token_files
from shelftide.llm.common import table
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r["doc_id"]: r["text"] for r in table(spark, folder, "documents").collect()}


def test_fertility_base_counts(spark, folder, texts):
    for r in queries.op1_fertility(spark, folder).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == brute.base_counts(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_entropy_of_two_equal_tokens_is_one_bit():
    assert fertility.entropies(np.array([5, 5, 6, 6, 9]), np.array([0, 4, 4, 5])).tolist() == [1.0, 0.0, 0.0]


def test_parts_of_characters_count_as_bytes():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = fertility._Encoder(fertility.Vocabulary("multi", "ranks", path, public_tokenizers.PATTERN))
    with open(path, "rb") as lines:
        entries = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
    whole = [entries[k].decode(errors="replace").encode() == entries[k] for k in sorted(entries)]
    assert encoder.is_byte[sorted(entries)].tolist() == [not w for w in whole]


def test_near_duplicates_like_all_pairs(spark, folder, texts):
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in queries.op2_near_duplicates(spark, folder).collect()}
    assert {i: c for i, (c, _) in got.items()} == brute.groups(texts)
    assert all(n == len(brute.shingles(texts[i])) for i, (_, n) in got.items())


def test_near_copies_beyond_the_pivot_are_linked(make_docs):
    """A chain: neighbours are similar, the ends are not; and a group of close variants."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(140)]
    chain = [(k, " ".join(words[4 * k : 4 * k + 100])) for k in range(10)]
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    variants = []
    for k in range(60):
        changed = list(base)
        for at in rng.sample(range(120), 4):
            changed[at] = f"x{k}_{at}"
        variants.append((100 + k, " ".join(changed)))
    rows = chain + variants
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.find_groups(make_docs(rows)).collect()}
    assert got == brute.groups(dict(rows))


def test_signature_agreement_estimates_the_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    sets = [np.unique(a[:800]), np.unique(a[100:])]
    one, two = near_duplicates.signatures(sets, 256)
    assert abs((one == two).mean() - 700 / 900) < 0.1
    parts = near_duplicates._signed_in_parts(sets, 256, limit=64)
    assert (parts == np.stack([one, two])).all()


def test_piece_codec_like_the_library(spark, folder, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in queries.op5_piece_codec(spark, folder).collect():
        ids = model.encode(texts[r["doc_id"]] or "", add_eos=True)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want


def test_piece_codec_on_random_strings_and_ids():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, codec, rng = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.PieceCodec(path), random.Random(11)
    letters = "aeinrst  ▁\n\t.,é日本語🙂☃<s>0x1  \x00"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        ids = model.encode(text)
        assert codec.encode(text.encode()).tolist() == ids
        assert codec.decode(ids) == model.decode(ids)
        wild = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999), 259]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(wild) == model.decode(wild)
    long_word = "ab" * 20000
    assert codec.encode(long_word.encode()).tolist() == model.encode(long_word)


def test_contamination_like_brute_force(spark, folder, texts):
    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    for r in queries.op6_decontamination(spark, folder).collect():
        got = (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
        assert got == brute.contamination(texts[r["doc_id"]], items)


def test_contamination_in_blocks_is_the_same(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    whole = decontamination.find_contamination(docs, items).drop("spans").collect()
    blocks = decontamination.find_contamination(docs, items, block_bytes=3000).drop("spans").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, blocks))


def test_short_items_and_cut_texts(spark, make_docs):
    items = spark.createDataFrame([(7, "Alpha beta, gamma!"), (8, None), (9, "...")], "item_id bigint, text string")
    docs = make_docs([(1, "x y ALPHA  beta-gamma z u v w q"), (2, "alpha beta"), (3, None)])
    found = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.find_contamination(docs, items).collect()}
    assert found == {1: (3, 1), 2: (0, 0), 3: (0, 0)}
    left = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, items).collect()}
    assert left == {1: "x y \n z u v w q", 2: "alpha beta", 3: None}


def test_a_cut_that_joins_a_window_is_cut_again(spark, make_docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    left = decontamination.decontaminate(make_docs([(1, "k1 k2 k3 k4 k5 a a b c b c k6 k7 k8")]), items).first()["text"]
    assert decontamination.words_of(left.encode()) == [b"k1", b"k2", b"k3", b"k4", b"k5", b"k6", b"k7", b"k8"]


def test_line_runs_like_brute_force(spark, folder, texts):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    got = {r["doc_id"]: r["text"] for r in line_runs.delete_repeated_runs(docs).collect()}
    assert got == brute.left_lines(sorted(texts.items()))


def test_line_runs_of_short_lines_need_several_doublings(make_docs):
    body = [f"line {k % 7}" for k in range(120)]
    rows = [(1, "\n".join(body)), (2, "\n".join(["new", *body[10:90], "end"])), (3, "\n".join(body[:20]))]
    got = {r["doc_id"]: r["text"] for r in line_runs.delete_repeated_runs(make_docs(rows)).collect()}
    assert got == brute.left_lines(rows)
    assert got[2] == "new\nend" and got[3] == rows[2][1]


@pytest.mark.parametrize("same_id", [None, 5])
def test_a_thousand_equal_rows_are_one_document(spark, make_docs, same_id):
    """The lines staged, the sets staged and the sampled rows do not grow with the copies."""
    text = "\n".join(" ".join(f"w{10 * k + j}" for j in range(10)) for k in range(20))
    docs = make_docs([(same_id, text)] * 1000 + [(9, text), (10, text.replace("w7 ", "x7 "))])
    got = line_runs.delete_repeated_runs(docs).collect()
    assert sum(r["text"] == text for r in got) == 1000 and len(got) == 1002
    spans = line_runs.repeated_spans(docs).collect()
    assert sum(r["doc"] not in (9, 10) for r in spans) == 0
    assert all(len(r["spans"]) == len(set(map(tuple, r["spans"]))) for r in spans) and len(spans) == 2
    groups = near_duplicates.find_groups(docs).collect()
    assert len(groups) == 1002 and {r["component_id"] for r in groups if r["doc_id"] is not None} == {same_id or 9}
    sample = labelled_sample.sample_ids(docs.select("doc_id"), "doc_id", 10)
    sampled = labelled_sample.with_texts(sample, docs, "doc_id", "text").collect()
    assert sorted(r["sample_id"] for r in sampled) == sorted({same_id or 9, 9, 10})


@pytest.mark.parametrize("dictionary", [True, False])
def test_token_files_round_trip(spark, folder, texts, tmp_path, dictionary):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = token_files.encode_documents(table(spark, folder, "documents"), path, end_id=0, shards=3)
    written = token_files.write_tokens(coded, str(tmp_path / "tokens"), token_files.FileLayout(dictionary=dictionary))
    got = {r["doc_id"]: tuple(r)[1:] for r in token_files.with_checksums(token_files.read_tokens(spark, written)).collect()}
    tokenizer, start = Tokenizer.from_file(path), 0
    for i, text in sorted(texts.items()):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_have_a_page_index_and_are_read_selectively(spark, folder, tmp_path):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    coded = token_files.encode_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, shards=2)
    written = token_files.write_tokens(coded, str(tmp_path / "tokens"))
    column = pq.ParquetFile(next((tmp_path / "tokens").glob("*.parquet"))).metadata.row_group(0).column(0)
    assert column.has_offset_index and column.has_column_index
    numbers = token_files.read_tokens(spark, written, where=F.col("doc_id") < 10, tokens=False)
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "array" not in plan and "LessThan(doc_id,10)" in plan
    assert numbers.count() == 10


def test_word_cache_equals_the_library_on_odd_spaces():
    from tokenizers import Tokenizer

    from shelftide.llm.word_cache import CachedEncoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer, rng = CachedEncoder(path), Tokenizer.from_file(path), random.Random(2)
    letters = "ab 1'sé\n .,\t  \x1c​日<|endoftext|>  "
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_word_cache_in_slices_with_a_full_store(monkeypatch):
    """Slices of texts whose words come with and without marks, in a store that is thinned out again and again."""
    from tokenizers import Tokenizer

    from shelftide.llm import word_cache

    monkeypatch.setattr(word_cache, "CACHE_WORDS", 40)
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer, rng = word_cache.CachedEncoder(path), Tokenizer.from_file(path), random.Random(3)
    words = [f"{stem}{end}{mark}" for stem in ("the", "Zürich", "it's", "x9", "日本", "<|endoftext|>", "a.b", "") for end in ("", "s", "7") for mark in ("", ".", ",", "!", "?!", ";", ":", "'")]
    for _ in range(120):
        texts = ["".join(rng.choice(words) + rng.choice(" \n ") for _ in range(rng.randint(0, 30))).strip(" \n") or None for _ in range(rng.randint(0, 8))]
        texts += rng.choices([None, "", " start", "\nstart", "two  blanks", "."], k=2)
        ids, sizes = encoder.encode_texts([t if t is None else t.encode() for t in texts], 0)
        want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
        assert len(encoder.numbers) == len(encoder.starts) == len(encoder.sizes) == len(encoder.met)
    ids, sizes = encoder.encode_texts([])
    assert len(ids) == len(sizes) == 0


def test_a_mark_behind_a_word_needs_no_second_search(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, codec, searched = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.PieceCodec(path), []
    split = codec.split
    monkeypatch.setattr(codec, "split", lambda text: searched.append(text) or split(text))
    text = "zorbelan zorbelan, zorbelan. zorbelan! caféro caféro; zorbelan: zorbelan?\ncaféro, 3, )."
    assert codec.encode(text.encode()).tolist() == model.encode(text)
    assert [w.lstrip(piece_codec.BLANK) for w in searched] == ["zorbelan", "caféro", "\ncaféro", "3,", ")."]


def test_words_met_again_stay_in_a_full_store():
    store = piece_codec.WordStore(10)
    store.keep(b"often", b"1")
    for k in range(200):
        store.keep(b"%d" % k, b"2")
        assert store.get(b"often") == b"1"
        assert len(store) <= 11
    assert store.get(b"0") is None


def test_new_pieces_are_not_looked_up_again():
    from tokenizers import Tokenizer

    from shelftide.llm import word_cache

    path, looked = public_tokenizers.path("byte_bpe_50k.json"), []

    class Watched(word_cache._Numbers):
        def __getitem__(self, piece):
            looked.append(piece)
            return super().__getitem__(piece)

    encoder = word_cache.CachedEncoder(path)
    encoder.numbers = Watched()
    encoder.numbers[b"\t"] = 0
    texts = ["Zorb quax, quax vimble.\nQuax! nori", "zorb", "\nquax, nori;\nZorb café."]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        ids, sizes = encoder.encode_texts([t.encode() for t in texts])
        assert ids.tolist() == [i for w in want for i in w]
        assert sizes.tolist() == [len(w) for w in want]
    # Every word of both passes once, and the words in front of the five marks that follow an ASCII letter.
    words = sum(len(t.replace("\n", " \n").split(" ")) for t in texts)
    assert len(looked) <= 2 * words + 5
