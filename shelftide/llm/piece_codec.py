"""SentencePiece encoding and decoding by backtracking over a merge vocabulary.

Merging always the best-scored neighbours gives one token sequence. The same sequence is
found from left to right: take the longest piece that matches (Aho-Corasick), keep it if it
is compatible with the token before, else try the next shorter piece that is a prefix of it, else
go back one token. Two neighbours are compatible if merging their joined text afresh gives the
two again; a sequence of which all neighbours are compatible is the merged one, because a
first merge over a border would happen in the two tokens alone as well. A position from
which no way led on is marked in a bitfield and never tried again, so time is linear in the
length of a text.

Texts are cut where no merge can reach over: in front of a run of blanks, if no piece
holds a blank behind another character, around a line feed, if no piece holds one, and between a letter and a mark
that ends its word, if no piece holds that mark behind a letter. The ids of a cut piece are kept for its next
occurrence, in a store of bounded size that gives up first what was not met for longest.

Characters without a piece become the pieces of their bytes, or the unknown id.

Defined results: a NULL text is an empty one; repeated rows each get a row; no rows give no rows. Texts of any length are worked on whole, a few megabytes of
documents at a time, and long words in pieces that no merge crosses. Other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftide.llm.common import held_by_worker, id_and_text, lean, map_slices, text_slices, unused_name

BLANK = "▁"
STORE_WORDS = 250_000
PAIR_STORE = 200_000
# Rows of ids that are decoded before they are passed on.
DECODED_ROWS = 256
# Fixed value: what the library prints for the unknown id.
UNKNOWN_TEXT = " ⁇ "


class WordStore:
    """Ids of words, at most ``limit``. When the newer half is full it becomes the older one, which is dropped
    but for the words that have been met again."""

    def __init__(self, limit: int) -> None:
        self.half = limit // 2
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __len__(self) -> int:
        return len(self.newer) + len(self.older)

    def get(self, key: bytes) -> bytes | None:
        found = self.newer.get(key)
        if found is None:
            found = self.older.get(key)
            if found is not None:
                self.keep(key, found)
        return found

    def keep(self, key: bytes, ids: bytes) -> bytes:
        if len(self.newer) >= self.half:
            self.older, self.newer = self.newer, {}
        self.newer[key] = ids
        return ids


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds = [
            (i, model.id_to_piece(i), model.is_byte(i), model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
            for i in range(model.vocab_size())
        ]
        self._require_plain_model(model)
        self.end_id, self.unknown_id = model.eos_id(), model.unk_id()
        self.special = {i for i, _, _, special in kinds if special}
        self.pieces = [piece for _, piece, _, _ in kinds]
        self.byte_of = {i: int(piece[1:-1], 16) for i, piece, is_byte, _ in kinds if is_byte}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.id_of = {p: i for i, p, is_byte, special in kinds if not (is_byte or special)}
        self.score = {p: model.get_score(i) for p, i in self.id_of.items()}
        self._prepare()

    @staticmethod
    def _require_plain_model(model) -> None:
        """The operator states no normalisation, so a model that has one is refused."""
        probe = "a  b Ａé "
        if model.normalize(probe) != BLANK + probe.replace(" ", BLANK):
            raise ValueError("the model normalises texts or puts no blank in front; only identity models are supported")

    def _prepare(self) -> None:
        import ahocorasick

        self.matcher = ahocorasick.Automaton()
        # A match of one character says nothing new.
        for piece in [p for p in self.id_of if len(p) > 1] or self.id_of:
            self.matcher.add_word(piece, (len(piece) - 1, piece))
        self.matcher.make_automaton()
        # The next shorter piece that is a prefix; a first character is the last resort.
        self.shorter = {
            p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id_of), p[0] if len(p) > 1 else None)
            for p in self.id_of
        }
        inner = any(BLANK in p.lstrip(BLANK) for p in self.id_of)
        self.cut = None if inner or any("\n" in p for p in self.id_of) else re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words, self.runs = WordStore(STORE_WORDS), WordStore(STORE_WORDS)
        # Marks that no piece holds behind a letter.
        fixed = {p[k] for p in self.id_of for k in range(1, len(p)) if p[k - 1].isalpha()}
        self.marks = {m.encode(): self._word(m) for m in ".,!?;:" if m not in fixed}
        # Text of each id. A byte below 128 is a character of its own wherever it stands.
        self.texts = [
            chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else "" if i in self.special else p.replace(BLANK, " ")
            for i, p in enumerate(self.pieces)
        ]
        self.plain = np.array([self.byte_of.get(i, 0) < 128 and i != self.unknown_id for i in range(len(self.pieces))])

    # Encoding

    def merged(self, text: str) -> list[str]:
        """Merging best neighbours first, the leftmost among equals: the definition, used for
        the texts of two tokens only."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIR_STORE:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def split(self, text: str) -> list[str]:
        """The pieces (single characters where there is none) of a text with visible blanks."""
        n = len(text)
        longest: list[str] = list(text)
        for end, (back, piece) in self.matcher.iter(text):
            longest[end - back] = piece  # longer matches of a start come later
        failed = bytearray(n + 1)
        tokens: list[str] = []
        pairs, shorter = self.pairs, self.shorter
        at, end, last, token = 0, 0, None, longest[0] if n else None
        while at < n:
            while token is not None:
                end = at + len(token)
                if not failed[end]:
                    if last is None:
                        break
                    fits = pairs.get((last, token))
                    if fits or (fits is None and self.compatible(last, token)):
                        break
                token = shorter.get(token)
            if token is None:
                if last is None:
                    raise ValueError("no merged sequence")
                failed[at] = 1
                token = tokens.pop()
                last = tokens[-1] if tokens else None
                at -= len(token)
            else:
                tokens.append(token)
                at, last = end, token
                token = longest[at] if at < n else None
        return tokens

    def piece_ids(self, token: str) -> list[int]:
        number = self.id_of.get(token)
        if number is not None:
            return [number]
        if self.byte_id:
            return [self.byte_id[b] for b in token.encode()]
        return [self.unknown_id]

    def _word(self, word: str) -> bytes:
        tokens = self.split(word)
        ids = [self.id_of.get(t) for t in tokens]
        if None in ids:
            ids = [i for t in tokens for i in self.piece_ids(t)]
        return array("i", ids).tobytes()

    def _run(self, word: str) -> bytes:
        key = word.encode()
        return self.runs.get(key) or self.runs.keep(key, self._word(word))

    def _plain(self, key: bytes) -> bytes:
        """A word by its bytes; one that starts a line has a line feed in front, others have a blank that is not shown."""
        found = self.words.get(key)
        if found is None:
            mark = self.marks.get(key[-1:])
            if mark is not None and (key[-2:-1].isalpha() or key[-2:-1] >= b"\x80" and key.decode()[-2].isalpha()):
                return self._plain(key[:-1]) + mark
            text = key.decode()
            found = self.words.keep(key, self._word(text if text[:1] == "\n" else BLANK + text))
        return found

    def encode(self, data: bytes | None) -> np.ndarray:
        """The ids of a text without the end id."""
        if not data:
            return np.empty(0, "<i4")
        if self.cut is None:
            return np.frombuffer(self._word(BLANK + data.decode().replace(" ", BLANK)), "<i4")
        ends = data[:1] == b" " or data[-1:] in (b" ", b"\n")
        if ends or b"  " in data or b" \n" in data or b"\n\n" in data or b"\xe2\x96\x81" in data:
            # Runs of blanks or line feeds: cut in general.
            text = BLANK + data.decode().replace(" ", BLANK)
            coded = [self._run(w) for w in self.cut.findall(text)]
        else:
            # The blank in front of the text makes the first word one like the others; a word that
            # starts a line has a line feed in place of the blank.
            coded, known = [], self.words.newer
            for key in data.replace(b"\n", b" \n").split(b" "):
                found = known.get(key)
                if found is None:
                    found = self._plain(key)
                    known = self.words.newer
                coded.append(found)
        return np.frombuffer(b"".join(coded), "<i4")

    # Decoding

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: control ids are silent, runs of byte pieces are read as UTF-8 (a byte
        that fits nowhere gives the replacement character), the first blank goes."""
        ids = np.asarray(ids, np.int64)
        if self.plain[ids].all():
            start = 0
            while start < len(ids) and int(ids[start]) in self.special:
                start += 1
            text = "".join(map(self.texts.__getitem__, ids.tolist()))
            return text[1:] if start < len(ids) and self.pieces[ids[start]][0] == BLANK else text
        out: list[str] = []
        run = bytearray()
        first = True
        table, byte_of, special = self.pieces, self.byte_of, self.special
        for i in ids.tolist():
            if i in byte_of:
                run.append(byte_of[i])
                continue
            if run:
                out.append(_lenient(run))
                run.clear()
                first = False
            if i in special:
                if i == self.unknown_id:
                    out.append(UNKNOWN_TEXT)
                    first = False
                continue
            piece = table[i]
            out.append(piece[1:] if first and piece[0] == BLANK else piece)
            first = False
        if run:
            out.append(_lenient(run))
        return "".join(out).replace(BLANK, " ")


def _lenient(run: bytearray) -> str:
    """UTF-8 with one replacement character for each byte that fits nowhere."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def piece_codec(path: str) -> PieceCodec:
    """One per worker process, until tasks of another operator come."""
    return held_by_worker(path, lambda: PieceCodec(path))


def encode_column(
    docs: DataFrame, model_file: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None
) -> DataFrame:
    """``docs`` with a column of ids, the end id last; with ``decoded_col`` also the text decoded from
    them in the same pass. A NULL text is encoded like an empty one. Existing columns of these names are
    replaced."""
    added = {c.lower() for c in (ids_col, decoded_col) if c}
    kept = [c for c in docs.columns if c.lower() not in added or c == text_col]
    data = unused_name([*kept, *added], "data")
    source = docs.select(*kept, F.col(text_col).cast("binary").alias(data))
    fields = [*source.drop(data).schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*fields, T.StructField(decoded_col, T.StringType())] if decoded_col else fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model_file)
        end = np.array([codec.end_id], "<i4")
        for batch in batches:
            for part in text_slices(batch, data):
                coded = [np.concatenate([codec.encode(x), end]) for x in part.column(data).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
                values = np.concatenate(coded) if coded else np.empty(0, "<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                arrays = [a for a, name in zip(part.columns, part.schema.names, strict=True) if name != data]
                decoded = [pa.array([codec.decode(c) for c in coded], pa.string())] if decoded_col else []
                yield pa.RecordBatch.from_arrays([*arrays, lists, *decoded], schema.names)

    return source.mapInArrow(lean(encode), schema)


def decode_column(rows: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids_col`` (NULL for NULL)."""

    kept = [c for c in rows.columns if c.lower() != text_col.lower() or c == ids_col]
    source = rows.select(*kept)
    schema = T.StructType([*source.schema.fields, T.StructField(text_col, T.StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model_file)
        for batch in batches:
            # A row at a time from the flat ids: as Python numbers those of a batch would not fit.
            for start in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(start, DECODED_ROWS)
                lists = part.column(ids_col)
                texts = [codec.decode(np.asarray(v.values)) if v.is_valid else None for v in lists]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], schema.names)

    return source.mapInArrow(lean(decode), schema)


def codec_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, and SHA-256 digests of its ids (decimal, joined by
    a blank) and of the text decoded from them. Encoded and decoded in one pass, so no
    list of ids leaves the task. A NULL text counts as empty: the end id alone."""

    def digests(part: pa.RecordBatch) -> pa.RecordBatch:
        codec = piece_codec(model_file)
        decimal = _decimals(codec)
        counts, of_ids, of_texts = [], [], []
        for data in part.column("data").to_pylist():
            ids = [*codec.encode(data).tolist(), codec.end_id]
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
            of_texts.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        arrays = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(id_and_text(docs, id_col, text_col), digests, schema, keeps=True)


def _decimals(codec: PieceCodec) -> list[str]:
    if not hasattr(codec, "decimals"):
        codec.decimals = [str(i) for i in range(len(codec.pieces))]
    return codec.decimals
