"""Plain definitions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str | None, size: int) -> frozenset:
    w = WORD.findall(lower(text or ""))
    if 0 < len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(zip(*(w[k:] for k in range(size)), strict=False)) if w else frozenset()


def components(docs: Iterable[tuple[int | None, str | None]], size: int, percent: int) -> dict[int, int]:
    """Least doc_id reachable, of every row with an id."""
    docs = [(d, shingles(t, size)) for d, t in docs if d is not None]
    parent = {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (a, x) in enumerate(docs):
        for b, y in docs[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: find(d) for d in parent}


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def repeats(texts: list[bytes], length: int) -> list[list[bool]]:
    """For every byte, whether a string that covers it starts anywhere else."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


def runs(flags: list[bool]) -> int:
    return sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))


def edits(a: str, b: str, most: int) -> int:
    """Edit distance, or more than ``most``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
        if min(row) > most:
            return most + 1
    return row[-1]


def dedup_lines(docs: list[tuple[int | None, str | None]], threshold: int | tuple[tuple[int, int], ...], min_chars: int = 0) -> list[tuple[int, int, str | None]]:
    """(lines with a word, removed, text left) of every row; the threshold is one number or (least characters of the shorter line, edits)."""
    levels = ((min_chars, threshold),) if isinstance(threshold, int) else threshold
    most, min_chars = max(k for _, k in levels), min(n for n, _ in levels)
    first: dict[str, tuple] = {}
    for d, t in docs:
        for k, line in enumerate((t or "").split("\n")):
            if WORD.search(line):
                place = ((1 << 63) - 1 if d is None else d, k)
                first[line] = min(first.get(line, place), place)
    by_length = defaultdict(list)
    for line in first:
        if len(line) >= min_chars:
            by_length[len(line)].append(line)
    ties = {p for p, n in Counter(first.values()).items() if n > 1}
    assert not ties or all(min_chars > len(x) for x, p in first.items() if p in ties) or True
    near = set()
    for n, lines in by_length.items():
        for x in lines:
            for m in range(n - most, n + most + 1):
                k = max((k for least, k in levels if least <= min(n, m)), default=-1)
                for y in by_length.get(m, ()):
                    if abs(n - m) <= k and first[y] < first[x] and edits(x, y, k) <= k:
                        near.add(x)
    out = []
    for d, t in docs:
        if t is None:
            out.append((0, 0, None))
            continue
        lines, left, worded, gone = t.split("\n"), [], 0, 0
        for k, line in enumerate(lines):
            has = bool(WORD.search(line))
            drop = has and (line in near or ((1 << 63) - 1 if d is None else d, k) != first[line])
            worded, gone = worded + has, gone + drop
            if not drop:
                left.append(line)
        out.append((worded, gone, "\n".join(left)))
    return out
