"""Whole-text encoding word by word.

A byte-level tokenizer of this kind cuts a text before it merges, and always in front of white space
that follows something else. So a text is encoded in pieces (white space, then what
follows), and the ids of a piece are kept for its next occurrence. Texts in which
white space is not plain go through the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

CACHE_WORDS = 600_000

# Spaces beyond blank and line feed, or several in a row: the text is then encoded whole.
_ODD_ASCII = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD = re.compile(
    rb"\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2(?:\x80[\x80-\x8f\xa8-\xaf]|\x81[\x9f-\xa4])|\xe3\x80\x80|\xef\xbb\xbf"
)


def plain_spaces(data: bytes) -> bool:
    """Only single blanks and line feeds between words, none at the end."""
    if len(data.translate(None, _ODD_ASCII)) != len(data) or data[-1:] in (b" ", b"\n"):
        return False
    if b"  " in data or b"\n\n" in data or b" \n" in data or b"\n " in data:
        return False
    return data.isascii() or not _ODD.search(data)


class _Numbers(dict[bytes, int]):
    """Pieces numbered as they are met; ``fresh`` lists those whose ids are still to be found."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class CachedEncoder:
    """Ids of whole texts, equal to the library's.

    Texts come in slices. Each piece is looked up once and stands for a number; the pieces of a slice that are
    new go through the library in one call, and its ids are dealt back by the number of bytes that each id
    stands for. A mark at the end of a word is cut off before: such a word is its word without the mark, and
    the mark. When the store is full, pieces that were met once only leave it between slices, and beyond half
    of it the rarest do, so memory stays bounded.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # In a byte-level vocabulary one character of an entry is one byte of text.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for entry, number in vocabulary.items():
            self.n_bytes[number] = len(entry)
        # An added token that ends in a mark is never cut.
        added = {t.content.encode()[-1:] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = {m: self._ids(m.decode()) for m in (b".", b",", b"!", b"?", b";", b":") if m not in added}
        self.numbers = _Numbers()
        self.numbers[b"\t"] = 0  # a text that starts with a space has nothing in front of it
        self.pool, self.starts, self.sizes = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.met = np.zeros(1, np.int64)

    def _thin_out(self) -> None:
        least = max(2, int(np.partition(self.met, -CACHE_WORDS // 2)[-CACHE_WORDS // 2]) + 1)
        kept = self.met >= least
        kept[0] = True
        pieces = [p for p, k in zip(self.numbers, kept.tolist(), strict=True) if k]
        self.numbers = _Numbers()
        self.numbers.update(zip(pieces, range(len(pieces)), strict=True))
        at = np.flatnonzero(kept)
        self.pool, self.sizes, self.met = self._gather(at), self.sizes[at], self.met[at] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self) -> None:
        """Ids of all pieces that are numbered but not known. A piece starts with a line feed, with a tab at the
        start of a text, and with its first character where a blank stands in front of it."""
        numbers, marks, first = self.numbers, self.marks, len(self.starts)
        fresh, numbers.fresh = numbers.fresh, []
        # Behind a blank, at the start of a line, at the start of a text: pieces and their numbers.
        coded: tuple[list[bytes], ...] = ([], [], [])
        found: tuple[list[int], ...] = ([], [], [])
        marked = []
        kinds = {b"\n": 1, b"\t": 2}
        # Numbers were given in the order of the pieces. Words that had not been met without their mark come last.
        for taken in (fresh, numbers.fresh):
            for number, piece in enumerate(taken, first):
                mark = piece[-1:]
                if mark in marks and taken is fresh and piece[-2:-1].isalpha():
                    marked.append((number, numbers[piece[:-1]], mark))
                else:
                    kind = kinds.get(piece[:1], 0)
                    coded[kind].append(piece)
                    found[kind].append(number)
            first += len(taken)
        numbers.fresh = []
        grown = len(numbers) - len(self.starts)
        self.starts = np.concatenate([self.starts, np.zeros(grown, np.int64)])
        self.sizes = np.concatenate([self.sizes, np.zeros(grown, np.int64)])
        self.met = np.concatenate([self.met, np.zeros(grown, np.int64)])
        behind, lines, starts = coded
        if behind or lines or starts:
            # What starts a text is encoded behind a line feed, whose id is left out.
            text = b"".join([b" " + b" ".join(behind) if behind else b"", *lines, *[b"\n" + p[1:] for p in starts]])
            ids = self._ids(text.decode())
            lengths = np.fromiter(map(len, behind + lines + starts), np.int64)
            lengths[: len(behind)] += 1
            cuts = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(lengths)) + 1
            before = np.concatenate([[0], cuts[:-1]])
            before[len(behind) + len(lines) :] += 1
            at = np.array(found[0] + found[1] + found[2])
            self.starts[at], self.sizes[at] = len(self.pool) + before, cuts - before
            self.pool = np.concatenate([self.pool, ids])
        if marked:
            at, bodies = np.array([m[0] for m in marked]), np.array([m[1] for m in marked])
            ends = [self.marks[m[2]] for m in marked]
            sizes = self.sizes[bodies] + np.array([len(e) for e in ends])
            firsts = len(self.pool) + np.cumsum(sizes) - sizes
            ids = np.empty(int(sizes.sum()), np.uint32)
            of_mark = np.ones(len(ids), bool)
            of_mark[_spread(firsts - len(self.pool), self.sizes[bodies])] = False
            ids[~of_mark], ids[of_mark] = self._gather(bodies), np.concatenate(ends)
            self.starts[at], self.sizes[at] = firsts, sizes
            self.pool = np.concatenate([self.pool, ids])

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        return self.pool[_spread(self.starts[numbers], self.sizes[numbers])]

    def encode_texts(self, texts: list[bytes | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, ``end`` behind each, and the number of ids of each text."""
        if len(self.numbers) > CACHE_WORDS:
            self._thin_out()
        found, whole, number_of = [], [], self.numbers.__getitem__
        for data in texts:
            if not data:
                found.append(np.empty(0, np.int64))
            elif plain_spaces(data):
                pieces = data.replace(b"\n", b" \n").split(b" ")
                pieces[0] = b"\t" + pieces[0]
                found.append(np.fromiter(map(number_of, pieces), np.int64, len(pieces)))
            else:
                whole.append(self._ids(data.decode()))
                found.append(np.array([-len(whole)]))
        if self.numbers.fresh:
            self._learn()
        plain = np.concatenate([f for f in found if len(f) and f[0] >= 0] or [np.empty(0, np.int64)])
        self.met += np.bincount(plain, minlength=len(self.met))
        pool, starts, sizes = self.pool, self.starts, self.sizes
        extra = [*whole, np.array([] if end is None else [end], np.uint32)]
        own = np.array([len(e) for e in extra], np.int64)
        pool = np.concatenate([pool, *extra])
        starts = np.concatenate([starts, len(self.pool) + np.cumsum(own) - own])
        sizes = np.concatenate([sizes, own])
        last = np.array([len(sizes) - 1])
        numbers = np.concatenate([n for f in found for n in (f, last)]) if found else np.empty(0, np.int64)
        numbers = np.where(numbers < 0, len(self.sizes) - 1 - numbers, numbers)
        ids = pool[_spread(starts[numbers], sizes[numbers])]
        ends = np.cumsum(np.array([len(f) + 1 for f in found], np.int64))
        upto = np.concatenate([[0], np.cumsum(sizes[numbers])])[np.concatenate([[0], ends])]
        return ids, np.diff(upto)

    def encode(self, data: bytes | None) -> bytes:
        """One text, as little-endian 32-bit integers."""
        return self.encode_texts([data])[0].astype("<u4", copy=False).tobytes()


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


_LOADED: dict[str, CachedEncoder] = {}


def cached_encoder(path: str) -> CachedEncoder:
    """One per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = CachedEncoder(path)
    return _LOADED[path]
