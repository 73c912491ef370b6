"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number: str) -> bool:
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(number))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text: str | None, size: int) -> set:
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def roots(n: int, linked) -> list[int]:
    """The smallest position of each position's component."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if root(i) != root(j) and linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def similar(a: set, b: set, percent: int) -> bool:
    shared = len(a & b)
    return bool(a) and bool(b) and 100 * shared >= percent * (len(a) + len(b) - shared)


def fold(key) -> int:
    return zlib.crc32(("" if key is None else str(key)).encode())


def base_scores(rows: list[tuple]) -> dict:
    """key -> (n_tokens, n_known, N, base score) of (key, text) rows."""
    tokens = [(k, words(t) + [None]) for k, t in rows]
    counts = Counter(w for k, ws in tokens if fold(k) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    score = lambda ws: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
    return {k: (len(ws), sum(counts[w] > 0 for w in ws), n, score(ws)) for k, ws in tokens}
