"""The contracts of the corpus operators, written plainly in Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

_LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
_ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None, pattern: re.Pattern = _ALNUM) -> list[str]:
    return pattern.findall((text or "").translate(_LOWER))


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card = re.compile(r"[0-9]([\x20-]?[0-9])+")
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def luhn(digits):
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
        return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0

    found = [("email", *m.span()) for m in email.finditer(text)]
    found += [("ip", *m.span()) for m in ip.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in card.finditer(text) if 16 <= len(d := re.sub("[ -]", "", m[0])) <= 19 and luhn(d)]
    return found + [("phone", *m.span()) for m in phone.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def contaminated(docs: list[tuple], items: list[tuple]) -> dict:
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i : i + k])].add(item)
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if (own := tuple(w[i : i + k])) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[own]
        out[doc] = (len(w), sorted(hit), sorted(found - {None}))
    return out


def fingerprint(text: str | None, shingle: int = 4) -> int:
    w = words(text, _SOLID)
    parts = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints: dict[int, int], radius: int = 4) -> dict[int, int]:
    """Of each id the smallest id that it can reach."""
    up = {i: i for i in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def least_capacity(sizes: list[int], n: int) -> int:
    """By trying every capacity in halves, with the greedy rule."""

    def fits(capacity):
        shards, load = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if load + s > capacity:
                shards, load = shards + 1, 0
            load += s
        return shards <= n

    low, high = 0, max(sum(sizes), 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def n_grams(text: str | None) -> Counter:
    plain = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    counts = Counter()
    for word in plain.split():
        marked = f"_{word}_"
        for n in (1, 2, 3):
            counts.update(g for i in range(len(marked) - n + 1) if (g := marked[i : i + n]).strip("_"))
    return counts
