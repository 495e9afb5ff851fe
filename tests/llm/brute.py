"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def find(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x


def groups(keys: list, links) -> dict:
    parent = {k: k for k in keys}
    for a, b in links:
        a, b = sorted((find(parent, a), find(parent, b)))
        parent[b] = a
    return {k: find(parent, k) for k in keys}


def shingles(text: str | None, width: int) -> set:
    words = WORD.findall((text or "").translate(LOWER))
    return set(zip(*(words[k:] for k in range(width)))) if len(words) >= width else {tuple(words)} if words else set()


def similar_groups(rows: list[tuple], width: int, percent: int) -> dict:
    sets = {k: shingles(t, width) for k, t in rows}
    keys = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(keys) for b in keys[:i] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = groups(keys, links)
    return {k: (len(sets[k]), root[k]) for k in keys}


def earlier(rows: list[tuple], width: int) -> dict:
    """Removed flags per byte; ``rows`` in key order with different keys."""
    seen: set[bytes] = set()
    out = {}
    for key, text in rows:
        data = (text or "").encode()
        gone, new = bytearray(len(data)), set()
        for k in range(len(data) - width + 1):
            window = data[k : k + width]
            if window in seen:
                gone[k : k + width] = b"\1" * width
            new.add(window)
        seen |= new
        out[key] = (data, gone)
    return out


def repeated(rows: list[tuple], width: int) -> list[tuple[list[str], list[bool]]]:
    texts = [WORD.findall(t or "") for _, t in rows]
    times = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if times[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((w, gone))
    return out


def hits(text: str | None, items: list[tuple], width: int) -> tuple[int, int, list[str]]:
    words = ITEM_WORD.findall((text or "").translate(LOWER))
    gone, found = [False] * len(words), set()
    for name, item in items:
        own = ITEM_WORD.findall((item or "").translate(LOWER))
        n = min(width, len(own))
        for start in range(len(own) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[start : start + n]:
                    gone[i : i + n] = [True] * n
                    found.add(str(name))
    return len(words), sum(gone), sorted(found)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]
