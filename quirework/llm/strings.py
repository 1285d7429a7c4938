"""String distances for short names, shared by the operators that match written names."""

from __future__ import annotations

#: Pairs of characters a scanner takes for each other, each class written as its first. Fixed values.
CONFUSED = ("o0", "l1i|!", "s5", "hb8", "ec", "nu", "g9q", "tf7")
_SKELETON = str.maketrans({c: group[0] for group in CONFUSED for c in group[1:]})


def skeleton(s: str) -> str:
    """A lower-case name with look-alike characters written alike."""
    return s.replace("rn", "m").replace("vv", "w").replace("cl", "d").translate(_SKELETON)


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between a and b; most + 1 if above `most`."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    # What both begin or end with costs nothing.
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    n -= k
    z = 0
    while z < n and a[-1 - z] == b[-1 - z]:
        z += 1
    a, b = a[k : len(a) - z], b[k : len(b) - z]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    far = most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        # Only places at most `most` from the diagonal can be reached with so few edits.
        first, stop = max(1, i - most), min(len(b), i + most)
        row = [far] * (len(b) + 1)
        row[0] = low = i
        for j in range(first, stop + 1):
            y = b[j - 1]
            d = last[j - 1] + (x != y)
            if last[j] < d:
                d = last[j] + 1
            if row[j - 1] < d:
                d = row[j - 1] + 1
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and before[j - 2] < d:
                d = before[j - 2] + 1
            row[j] = d
            if d < low:
                low = d
        if low > most:
            return far
        before, last = last, row
    return min(last[-1], far)


def likeness(a: str, b: str) -> float:
    """1 for equal names, falling by the share of edits, on the names or on their skeletons; 0 below 0.6."""
    if a == b:
        return 1.0
    size = max(len(a), len(b), 1)
    most = size * 2 // 5
    if min(len(a), len(b)) + most < size:
        return 0.0
    d = edits(a, b, most)
    if d > 1:
        e = edits(skeleton(a), skeleton(b), most) + 0.25
        d = min(d, e)
    return max(0.0, 1 - d / size) if d <= most else 0.0
