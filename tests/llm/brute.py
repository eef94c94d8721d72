"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def shingles(text):
    lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
    words = WORD.findall(lower)
    if len(words) >= 5:
        return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def groups(texts):
    """From doc_id to its smallest linked doc_id. All pairs are compared."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def contamination(text, items, size=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {k: k + 32 for k in range(65, 91)}
    words = word.findall((text or "").translate(lower))
    hit, found = set(), set()
    for item, item_text in items:
        its = word.findall((item_text or "").translate(lower))
        n = min(size, len(its))
        windows = {tuple(its[k : k + n]) for k in range(len(its) - n + 1)} if n else set()
        for k in range(len(words) - n + 1 if n else 0):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit)


def left_lines(docs, min_words=50):
    """Texts after later copies of runs of ``min_words`` words went; docs: sorted (doc_id, text)."""
    seen, gone = set(), {i: set() for i, _ in docs}
    for i, text in docs:
        lines = (text or "").split("\n")
        for k in range(len(lines)):
            total = 0
            for j in range(k, len(lines)):
                total += len(WORD.findall(lines[j]))
                if total >= min_words:
                    run = tuple(lines[k : j + 1])
                    if run in seen:
                        gone[i].update(range(k, j + 1))
                    seen.add(run)
                    break
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in docs}


def trie(rows, span=100, most=6):
    """Node rows of the rebuilt conversations, every subtree walked. ``rows``: (conv_id, turn, role, text)."""
    own = {}
    first = lambda x: (x is not None, x or 0)
    for c, turn, role, text in sorted(rows, key=lambda r: (first(r[1]), r[2] or "", r[3] or "")):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = own.get(c - c % span, [])[:h] + turns[h:]
    members = {}
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    out = []
    for p, found in members.items():
        children = [q for q in below[p] if len(q) == len(p) + 1]
        leaves = sum(len(below[q]) == 1 for q in below[p])
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q)
        ends = ",".join(str(c) for c in found if len(built[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((found[0], len(p), parent, len(found), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0], r[1]))


def cut_text(text, items, size=10):
    """The text without hit words, round after round, and the share of words that stay."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    windows = set()
    for _, item in items:
        words = word.findall(low(item or ""))
        n = min(size, len(words))
        windows |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1) if n}
    share = 1.0
    while text is not None:
        flat = low(text)
        places = [(m.start(), m.end()) for m in word.finditer(flat)]
        words = [flat[a:b] for a, b in places]
        hit = sorted({p for n in {len(w) for w in windows} for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in windows for p in range(k, k + n)})
        if not hit:
            break
        pieces, last = [], 0
        for at, p in enumerate(hit):
            if at == 0 or hit[at - 1] != p - 1:
                pieces.append(text[last : places[p][0]])
            last = places[p][1]
        share *= 1 - len(hit) / len(words)
        text = "\n".join([*pieces, text[last:]])
    return text, share
