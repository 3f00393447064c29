"""Weighted Damerau-Levenshtein distance of typed names."""

from __future__ import annotations

# Rows of the usual keyboards; neighbours are likelier typos.
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
NEAR = {(a, b) for row in ROWS for a, b in zip(row, row[1:])} | {(a, b) for up, low in zip(ROWS, ROWS[1:]) for i, a in enumerate(up) for b in low[max(0, i - 1) : i + 1]}
NEAR |= {(b, a) for a, b in NEAR}
# Shapes that readers and scanners confuse.
LOOKS = {("l", "i"), ("i", "l"), ("o", "e"), ("u", "v"), ("v", "u"), ("c", "e"), ("e", "c"), ("n", "m"), ("m", "n"), ("t", "f"), ("f", "t")}
SWAP, DOUBLE, CLOSE = 0.7, 0.6, 0.75


def weighted_distance(a: str, b: str, most: float = 3.0) -> float:
    """Edits to turn ``a`` into ``b``: 1 each, less for swaps, doubled letters and keyboard neighbours. Above ``most``: inf."""
    if a == b:
        return 0.0
    la, lb = len(a), len(b)
    if abs(la - lb) * DOUBLE > most:
        return float("inf")
    before, last = [], [0.0] * (lb + 1)
    for j in range(1, lb + 1):
        last[j] = last[j - 1] + (DOUBLE if j > 1 and b[j - 1] == b[j - 2] else 1.0)
    for i in range(1, la + 1):
        x, px = a[i - 1], a[i - 2] if i > 1 else ""
        drop = DOUBLE if x == px else 1.0
        row = [last[0] + drop] + [0.0] * lb
        low = row[0]
        for j in range(1, lb + 1):
            y = b[j - 1]
            if x == y:
                best = last[j - 1]
            else:
                best = last[j - 1] + (CLOSE if (x, y) in NEAR or (x, y) in LOOKS else 1.0)
                if (v := last[j] + drop) < best:
                    best = v
                if (v := row[j - 1] + (DOUBLE if j > 1 and y == b[j - 2] else 1.0)) < best:
                    best = v
                if i > 1 and j > 1 and x == b[j - 2] and px == y and (v := before[j - 2] + SWAP) < best:
                    best = v
            row[j] = best
            if best < low:
                low = best
        if low > most:
            return float("inf")
        before, last = last, row
    return last[lb] if last[lb] <= most else float("inf")


def deletes(word: str, depth: int) -> set[str]:
    """``word`` and all strings left by deleting up to ``depth`` of its letters."""
    out, layer = {word}, {word}
    for _ in range(depth):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        out |= layer
    return out
