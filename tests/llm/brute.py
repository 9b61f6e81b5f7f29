"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import re
import zlib

SF_SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def DOCS(rows):  # noqa: N802
    """Special rows: nulls, empties, ties, copies, near copies, one very long text, odd characters."""
    long_text = " ".join(f"word{i % 977} x{i}" for i in range(20_000))
    base = " ".join(f"tok{i}" for i in range(60))
    near = " ".join(f"tok{i}" if i != 30 else "changed" for i in range(60))
    return [
        (100_001, None), (100_002, ""), (100_003, " \t\n\x0b\x0c\r "), (100_004, rows[0][1]), (100_005, rows[0][1]),
        (100_006, long_text), (100_007, long_text + " end"), (100_008, "one two three"), (100_009, "One  two\tTHREE"),
        (100_010, base), (100_011, near), (100_012, "x" + base + " tail of it"), (100_013, "a " * 400), (100_014, "a " * 399 + "b"),
        (100_015, "naïve café 日本語 🙂 Ünï ß " * 9), (100_016, "z" * 300), (100_017, "z" * 171 + "y"),
        (100_018, "12 34 %% --"), (None, base), (100_010, base),
    ]


def words(text):
    return WORD.findall(text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def repeated(rows, units, width):
    """Per row: the flags of the units that lie in a window that starts in a smaller doc_id."""
    first = {}
    for d, u in sorted(zip([d for d, _ in rows], units, strict=True), key=lambda x: x[0]):
        for i in range(len(u) - width + 1):
            first.setdefault(tuple(u[i : i + width]), d)
    out = []
    for (d, _), u in zip(rows, units, strict=True):
        go = [False] * len(u)
        for i in range(len(u) - width + 1):
            if first[tuple(u[i : i + width])] < d:
                go[i : i + width] = [True] * width
        out.append(go)
    return out


def shingles(text):
    w = words(low(text))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def jaccard_components(rows):
    sets = {}
    for d, x in rows:
        sets.setdefault(d, shingles(x))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                same = len(x & y)
                if 100 * same >= 75 * (len(x) + len(y) - same):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}
