"""Plain versions of the operators, for tables that fit in memory."""

from __future__ import annotations

import collections
import hashlib
import math
import re

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def simhash(text: str | None, shingle: int = 4) -> int:
    words = WORDS.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items: list, near) -> list[int]:
    """Number of each item's connected class."""
    found, number = [-1] * len(items), 0
    for i in range(len(items)):
        if found[i] < 0:
            found[i], todo = number, [i]
            while todo:
                x = todo.pop()
                for y in range(len(items)):
                    if found[y] < 0 and near(items[x], items[y]):
                        found[y] = number
                        todo.append(y)
            number += 1
    return found


def without_repeats(texts: list[bytes], length: int = 100) -> list[tuple[int, int, bytes]]:
    """Removed bytes, removed runs and kept bytes of texts in order."""
    seen, out = set(), []
    for b in texts:
        gone = [0] * (len(b) + 1)
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(s)
        flags, level = [], 0
        for x in gone[:-1]:
            level += x
            flags.append(level > 0)
        runs = sum(f and not p for f, p in zip(flags, [False, *flags]))
        out.append((sum(flags), runs, bytes(c for c, f in zip(b, flags) if not f)))
    return out


class KneserNey:
    """Word-pair model from texts."""

    def __init__(self, texts: list[str]):
        self.count, pairs = collections.Counter(), collections.Counter()
        for t in texts:
            words = self.tokens(t)
            self.count.update(words)
            pairs.update(zip(["<begin>", *words], words))
        self.pairs, self.tokens_, self.types = pairs, sum(self.count.values()), len(self.count)
        self.cont = collections.Counter(w for _, w in pairs)
        self.upper, self.lower = self.discounts(pairs.values()), self.discounts(self.cont.values())
        self.after, self.left = collections.Counter(), collections.Counter()
        for (v, _), n in pairs.items():
            self.after[v] += n
            self.left[v] += self.upper[min(n, 3)]

    @staticmethod
    def tokens(text: str | None) -> list:
        return [*WORDS.findall((text or "").translate(LOWER)), None]

    @staticmethod
    def discounts(counts) -> list[float]:
        n1, n2, n3, n4 = (sum(c == k for c in counts) for k in (1, 2, 3, 4))
        if not n1 or not n2:
            return [0, 0.5, 0.75, 0.9]
        y = n1 / (n1 + 2 * n2)
        raw = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5
        return [0, *(min(max(d, 0), k) for k, d in enumerate(raw, 1))]

    def chance(self, v, w) -> float:
        total = len(self.pairs)
        rest = sum(self.lower[min(x, 3)] for x in self.cont.values()) if total else 1.0
        p = (max(self.cont[w] - self.lower[min(self.cont[w], 3)], 0) + rest / (self.types + 1)) / max(total, 1)
        if not self.after[v]:
            return p
        n = self.pairs[(v, w)]
        return (max(n - self.upper[min(n, 3)], 0) + self.left[v] * p) / self.after[v]

    def score(self, text) -> tuple[int, int, float, float]:
        words = self.tokens(text)
        base = sum(math.log10((self.count[w] + 1) / (self.tokens_ + self.types + 1)) for w in words)
        model = sum(math.log10(self.chance(v, w)) for v, w in zip(["<begin>", *words], words))
        return len(words), sum(self.count[w] > 0 for w in words), base, model


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
