"""Plain Python answers to the corpus operators, and small corpora to ask about."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


def corpus(seed: int = 1, size: int = 60) -> list[tuple[int | None, str | None]]:
    """Texts with copies, near copies, shared passages, repeated rows, nulls and long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdéñ", k=rng.randint(1, 6))) for _ in range(400)]

    def text(n: int) -> str:
        return " ".join(rng.choices(vocabulary, k=n))

    passage = text(50)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(size):
        kind, body = i % 6, text(rng.randint(40, 160))
        if kind == 1:
            body = f"{text(30)} {passage}\n{text(20)}"
        elif kind == 2 and rows[-2][1]:
            body = rows[-2][1]
        elif kind == 3 and rows[-3][1]:
            near = rows[-3][1].split(" ")
            near[rng.randrange(len(near))] = "Changed"
            body = " ".join(near).upper() if i % 4 == 3 else " ".join(near)
        elif kind == 4:
            line = text(8)
            body = "\n".join([line] * 6 + [text(60)])
        rows.append((i * 3 + 1, body))
    rows += [(1000, None), (1001, ""), (1002, " \t\r\n"), (1003, "one"), (1004, "One"), (None, text(60))]
    rows += [(1005, rows[0][1]), rows[5], rows[5], (1006, "x" * 200_000), (1007, text(30_000))]
    rows += [(None, None), (1008, "a b c d"), (1009, "A b\tc d"), (1010, ("ab " * 300).strip())]
    return rows


def covered(words: list[bytes], width: int, found: Counter) -> list[bool]:
    gone = [False] * len(words)
    for i in range(len(words) - width + 1):
        if found[tuple(words[i : i + width])] > 1:
            gone[i : i + width] = [True] * width
    return gone


def windows(words: list[bytes], width: int) -> Counter:
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def substrings(rows: list, width: int) -> list[tuple]:
    found: Counter = Counter()
    for _, text in rows:
        found.update(windows(words_of(text), width))
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        gone = covered(words, width, found)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def quality(rows: list, min_repeat: int, max_covered: float, max_repeat: int) -> list[tuple]:
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        n = len(words)

        def cover(width: int, words=words) -> int:
            return sum(covered(words, width, windows(words, width)))

        lines = [x for x in (text or "").split("\n") if words_of(x)]
        short = cover(3)
        failed = n < 50 or 100 * short > 50 * n
        good = cover(min_repeat) <= max_covered * n and not cover(max_repeat + 1)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        chars = sum(len(w.decode()) for w in words)
        out.append(
            (doc_id, n, chars, symbols, len(lines) - len(set(lines)), short, failed, good and not failed)
        )
    return out


def near(rows: list, width: int = 5, percent: int = 75) -> list[tuple]:
    sets = []
    for _, text in rows:
        words = words_of(text, True)
        grams = [tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
        sets.append(frozenset(grams) if words else frozenset())
    parent = list(range(len(rows)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    inverted = defaultdict(list)
    for i, own in enumerate(sets):
        common: Counter = Counter()
        for gram in own:
            common.update(inverted[gram])
            inverted[gram].append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least: dict[int, int | None] = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids, default=None)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = least[find(i)] if sets[i] else doc_id
        kept = doc_id == name if doc_id is not None and name is not None else name is None
        out.append((doc_id, len(sets[i]), name, kept))
    return out


def contaminated(rows: list, items: list, width: int) -> list[tuple]:
    def split(text: str | None) -> list[str]:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return "".join(c if c.isascii() is False or c.isalnum() else " " for c in lowered).split(" ")

    grams = defaultdict(set)
    for item_id, text in items:
        words = [w for w in split(text) if w]
        for i in range(max(1, len(words) - width + 1)):
            if words:
                grams[tuple(words[i : i + width])].add(item_id)
    sizes = {len(g) for g in grams}
    out = []
    for doc_id, text in rows:
        words = [w for w in split(text) if w]
        hit, found = [False] * len(words), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if ids := grams.get(tuple(words[i : i + size])):
                    hit[i : i + size] = [True] * size
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(words), sum(hit), len(names), digest, any(hit)))
    return out


class Ppm:
    """A byte-context trie in dictionaries."""

    def __init__(self, order: int) -> None:
        self.order = order
        self.nodes: list[dict] = [defaultdict(Counter) for _ in range(order + 1)]

    def _padded(self, data: bytes) -> bytes:
        return b"\xff" * self.order + data + b"\xff"

    def learn(self, data: bytes) -> None:
        data = self._padded(data)
        for i in range(self.order, len(data)):
            for k in range(self.order + 1):
                self.nodes[k][data[i - k : i]][data[i]] += 1

    def log10(self, context: bytes, symbol: int) -> float:
        total, out = 0.0, set()
        for k in range(self.order, -1, -1):
            node = self.nodes[k].get(context[len(context) - k :])
            if not node:
                continue
            size = sum(n for s, n in node.items() if s not in out)
            types = sum(s not in out for s in node)
            if types and symbol in node:
                return total + math.log10(node[symbol] / (size + types))
            if types:
                total += math.log10(types / (size + types))
            out |= set(node)
        return total - math.log10(256 - len(out))

    def score(self, data: bytes) -> float:
        data = self._padded(data)
        return sum(self.log10(data[i - self.order : i], data[i]) for i in range(self.order, len(data)))


def letter_triples(text: str) -> Counter:
    """Triples of the lower-cased letters, with one space for anything between and at both ends."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    spaced = f" {' '.join(letters.split())} "
    return Counter(zip(spaced, spaced[1:], spaced[2:]))


def languages(rows: list, learn: list[bool], vectors, share: int) -> list[tuple[str, float]]:
    """(name, cosine) of each row of (id, text, lang), from plain sums of triples' vectors."""
    import numpy as np

    signs: dict[str, np.ndarray] = {}

    def vector(triple: tuple[str, str, str]) -> np.ndarray:
        for c in triple:
            if c not in signs:
                signs[c] = vectors(np.array([ord(c)]), 1024)[0].astype(float)
        a, b, c = (signs[x] for x in triple)
        return np.roll(a, 2) * np.roll(b, 1) * c

    def bundle(counts: dict) -> np.ndarray:
        return sum((n * vector(t) for t, n in counts.items()), np.zeros(1024))

    found = [letter_triples(text) if text and any(c.isalpha() for c in text) else None for _, text, _ in rows]
    learnt: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(1024))
    for (_, _, lang), counts, own in zip(rows, found, learn, strict=True):
        if own and lang is not None and counts:
            total = sum(counts.values())
            learnt[lang] += bundle({t: max(1, round(n * (share / total))) for t, n in counts.items()})
    out = []
    for counts in found:
        best = ("und", 0.0)
        if counts:
            own = bundle(counts)
            for name in sorted(learnt):
                cosine = own @ learnt[name] / max(np.linalg.norm(own) * np.linalg.norm(learnt[name]), 1e-9)
                if best[0] == "und" or cosine > best[1]:
                    best = (name, max(0.0, float(cosine)))
        out.append(best)
    return out
