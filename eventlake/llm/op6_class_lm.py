"""LM scoring by Brown class-based bigrams.

log10 P(text) = sum over tokens of log10 P(class | previous class) + log10
P(token | class). Tokens are the words of a text (A-Z lowered) and one end.
Method:

1. Word counts over all training documents: each block sends its distinct words
   with their counts to hash slots and is told the totals in the order sent. Its
   words, totals and word numbers become one row of a table, which all later steps
   read: no text is split or shuffled again. Words of one count below ``least`` and
   one kind are one word there, as nothing tells them apart any more.
2. Units: a word seen ``least`` times or more is a unit of its own; rarer ones
   belong to the unit of their count band (powers of two) and last character's kind.
3. Seed: words with at least ``share`` of all tokens (at most 1 / share of them)
   and bands for all others are clustered on the driver by exchange: one after the
   other moves to the class that gains most in average mutual information, until
   nothing moves or ``sweeps`` are done. Every unit starts in its seed's class, one
   word of ``SPREAD`` in a class of its hash, so that words of a band differ.
4. Exchange of all units, ``rounds`` times: the blocks send each unit's counts by
   neighbour class (a byte or two each) to slots, which sum them and move every other unit (by hash, in turn) to the class
   that gains most against the class bigrams (classes squared, broadcast), all others
   fixed; the table of classes is written and told to the blocks. A round that does
   not raise the mutual information is dropped and ends the exchange.
5. Class transitions are smoothed towards the class frequencies (``beta`` pseudo
   tokens); a class emits its units and a band its words by their counts, and the
   band of words seen once gives half its mass to words never seen.

Null and empty texts are one end token; repeated rows are counted and scored one
by one; rows without doc_id are left out; without training tokens all scores are
0. Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.blocks import in_blocks
from eventlake.llm.components import remove, written

SHARE = 5e-4
CLASSES = 32
SWEEPS = 8
BETA = 20.0
BANDS, KINDS = 40, 3
#: a power of two, so that a band is rare as a whole or not at all
LEAST = 4
ROUNDS = 4
#: one word of so many starts in a class of its hash; one unit of so many moves in a round
SPREAD, PARTS = 4, 2
END = np.uint64(0x0123456789ABCDEF)
BLOCK = 3 << 19
#: units of the bands
RARE = t.mix(np.arange(BANDS * KINDS, dtype=np.uint64))


def in_training(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 != 2


def _blobs(values: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Binary column: of each row the bytes of its values."""
    return t.strings(np.ascontiguousarray(values).view(np.uint8), np.asarray(offs) * values.itemsize, binary=True)


def _values(column, dtype) -> np.ndarray:
    """All values of a column of :func:`_blobs`."""
    return np.frombuffer(t.text_bytes(column)[0].tobytes(), dtype)


def _sizes(column, dtype) -> np.ndarray:
    """Number of values in each row of a column of :func:`_blobs`."""
    return np.diff(t.text_bytes(column)[1]) // np.dtype(dtype).itemsize


class Words:
    """Texts of one block as numbers of its distinct words; every row ends with one end token."""

    def __init__(self, docs):
        self.doc_id = t.ids(docs["doc_id"])
        buf, offs = t.text_bytes(docs["text"])
        buf = t.lower_ascii(buf)
        starts, ends, row = t.words(buf, offs)
        n = len(self.doc_id)
        self.size = np.bincount(row, minlength=n) + 1
        stop = np.cumsum(self.size) - 1
        total = int(self.size.sum())
        word = np.ones(total, bool)
        word[stop] = False
        token = np.full(total, END)
        token[word] = t.span_hash(buf, starts, ends)
        last = buf[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        kind = np.zeros(total, np.uint8)
        stops = (last == 46) | (last == 33) | (last == 63)
        kind[word] = np.where(stops, 1, np.where((last >= 97) & (last <= 122) | (last >= 128), 0, 2))
        self.hash, first, self.at = np.unique(token, return_index=True, return_inverse=True)
        self.kind = kind[first]
        training = np.array([in_training(d) for d in self.doc_id.tolist()], bool)
        seen = np.repeat(training, self.size) if n else np.zeros(0, bool)
        self.count = np.bincount(self.at[seen], minlength=len(self.hash)).astype(np.int64)


def _ask(slots: int):
    def fn(key, docs):
        w = Words(docs)
        return t.dealt(t.slot_of(w.hash, slots), key[0].as_py(), {"hash": w.hash, "count": w.count})

    return fn


#: one row per block: its rows' ids and sizes, its distinct words with totals and kinds, and the words' numbers in a row
_TOKENS = "slot int, doc_id binary, size binary, hash binary, count binary, kind binary, at binary"


def _tokens(frequent: np.ndarray, least: int, slots: int):
    """Of one block: its texts as word numbers, with the totals of its words; frequent is sorted."""

    def fn(docs, told):
        w = Words(docs) if docs.num_rows else None
        if w:
            order = np.argsort(t.slot_of(w.hash, slots), kind="stable")
            w.count[order] = t.longs(told.take(pa.array(np.argsort(t.ids(told["origin"]), kind="stable")))["count"]).view(np.int64)
            alike = (w.count < least) & (w.hash != END) & ~t.has(frequent, w.hash)
            w.hash[alike] = t.mix((w.count * KINDS + w.kind)[alike].astype(np.uint64) + np.uint64(1 << 32))
            w.hash, first, number = np.unique(w.hash, return_index=True, return_inverse=True)
            w.count, w.kind, w.at = w.count[first], w.kind[first], number[w.at]
        cols = {"slot": pa.array([docs["block"][0].as_py()] if w else [], pa.int32())}
        for name in ("doc_id", "size", "hash", "count", "kind", "at"):
            v = getattr(w, name) if w else np.zeros(0, np.int64)
            if name == "count" and v.max(initial=0) < 1 << 32:
                v = v.astype(np.uint32)
            elif name == "at" and w:
                v = v.astype(np.uint16 if len(w.hash) <= 1 << 16 else np.uint32)
            cols[name] = _blobs(v, [0, len(v)] if w else [0])
        return pa.table(cols)

    return fn


class Tokens:
    """Token stream of one block: every row's words and its end, from a row of the table of tokens."""

    def __init__(self, table):
        self.doc_id, self.size = _values(table["doc_id"], np.int64), _values(table["size"], np.int64)
        n, total = len(self.doc_id), int(self.size.sum())
        self.stop = np.cumsum(self.size) - 1  # each row's end token
        self.first = self.stop - self.size + 1
        self.row = np.repeat(np.arange(n), self.size)
        words = _values(table["hash"], np.uint64)
        at = _values(table["at"], np.uint16 if len(words) <= 1 << 16 else np.uint32)
        count = t.text_bytes(table["count"])[0].tobytes()
        self.words, self.at = words, at
        self.word_count = np.frombuffer(count, np.int64 if len(count) == 8 * len(words) else np.uint32).astype(np.int64)
        self.word_kind = _values(table["kind"], np.uint8).astype(np.int64)
        self.count = self.word_count[at]
        self.training = np.array([in_training(d) for d in self.doc_id.tolist()], bool)[self.row] if total else np.zeros(0, bool)


def _totals(share: float):
    """Of one slot: to each block the totals of the words it sent, in its order; for all (slot -1): tokens, words, and those that may be frequent."""

    def fn(key, table):
        words, at = np.unique(t.longs(table["hash"]), return_inverse=True)
        total = np.bincount(at, t.longs(table["count"]).view(np.int64), len(words)).astype(np.int64)
        rows, offs = table.num_rows, np.concatenate([[0], np.cumsum(t.lengths(table["hash"]))])
        often = total >= max(1, share * total.sum())
        return pa.table({
            "slot": pa.array(np.append(t.ids(table["src"]), -1).astype(np.int32)),
            "origin": pa.array(np.full(rows + 1, key[0].as_py(), np.int32)),
            "hash": pa.array([[]] * rows + [words[often].view(np.int64)], pa.list_(pa.int64())),
            "count": pa.ListArray.from_arrays(pa.array(np.append(offs, offs[-1] + often.sum()).astype(np.int32)), pa.array(np.concatenate([total[at], total[often]]))),
            "tokens": pa.array(np.append(np.zeros(rows, np.int64), total.sum())),
            "words": pa.array(np.append(np.zeros(rows, np.int64), (total > 0).sum())),
        })

    return fn


def _bands(tokens: Tokens) -> np.ndarray:
    """Band of every distinct word by its count and kind."""
    return np.minimum(np.floor(np.log2(np.maximum(tokens.word_count, 1))).astype(np.int64), BANDS - 1) * KINDS + tokens.word_kind


def _units(tokens: Tokens, frequent: np.ndarray) -> np.ndarray:
    """Unit of every token; frequent is sorted."""
    f = len(frequent)
    unit = f + _bands(tokens)
    unit[tokens.words == END] = f + BANDS * KINDS
    if f:
        at = np.minimum(np.searchsorted(frequent, tokens.words), f - 1)
        known = (frequent[at] == tokens.words) & (tokens.words != END)
        unit[known] = at[known]
    return unit[tokens.at]


def _bigrams(frequent: np.ndarray, slots: int):
    """Of one block: counts of (previous unit, unit) over its training documents; a text starts after a start mark."""
    n_units = len(frequent) + BANDS * KINDS + 1

    def fn(docs):
        x = Tokens(docs)
        unit = _units(x, frequent)
        before = np.empty_like(unit)
        before[1:] = unit[:-1]
        before[x.first] = n_units
        pair, count = np.unique((before * n_units + unit)[x.training], return_counts=True)
        return t.dealt(pair % slots, 0, {"pair": pair, "count": count})

    return fn


def _sum_pairs(table):
    pair, number = np.unique(t.longs(table["pair"]).view(np.int64), return_inverse=True)
    return pa.table({"pair": pa.array(pair), "count": pa.array(np.bincount(number, t.longs(table["count"]), len(pair)).astype(np.int64))})


def exchange(m: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of every unit, from the (units + 1) x units bigram counts whose last row is the start mark."""
    n = m.shape[1]
    follow, start = m[:n].astype(float), m[n].astype(float)
    freq = follow.sum(0) + start
    order = np.argsort(-freq, kind="stable")
    cls = np.empty(n, np.int64)
    cls[order] = np.minimum(np.arange(n), classes - 1) if n <= classes else np.arange(n) % classes
    member = np.eye(classes)[cls]
    g = member.T @ follow @ member  # class bigrams
    s = start @ member
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    for _ in range(sweeps):
        moved = 0
        for w in order.tolist():
            if freq[w] == 0:
                continue
            old = int(cls[w])
            member[w, old] = 0
            to, frm, own = follow[w] @ member, follow[:, w] @ member, follow[w, w]
            g[old] -= to
            g[:, old] -= frm
            g[old, old] -= own
            s[old] -= start[w]
            right, left = g.sum(1), g.sum(0) + s
            base = xlogx(g)
            # value of the class bigrams if w joined each class: its row, its column, its diagonal
            rows = xlogx(g + to) - base
            cols = xlogx(g + frm[:, None]) - base
            d = np.arange(classes)
            gain = rows.sum(1) + cols.sum(0) - rows[d, d] - cols[d, d] + xlogx(g[d, d] + to + frm + own) - base[d, d]
            gain += xlogx(s + start[w]) - xlogx(s)
            gain -= xlogx(right + to.sum() + own) - xlogx(right) + xlogx(left + freq[w]) - xlogx(left)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            cls[w] = new
            member[w, new] = 1
            g[new] += to
            g[:, new] += frm
            g[new, new] += own
            s[new] += start[w]
        if not moved:
            break
    return cls


class ClassModel:
    """Seed: classes of the frequent words and of the bands, smoothed class transitions and unit emissions."""

    def __init__(self, m: np.ndarray, frequent: np.ndarray, tokens: int, words: int, classes: int, sweeps: int, beta: float):
        self.frequent, self.tokens, self.words = frequent, tokens, words
        n = m.shape[1]
        self.cls = exchange(m, classes, sweeps)
        member = np.eye(classes)[self.cls]
        unit = m.sum(0).astype(float)
        self.band = unit[len(frequent) : len(frequent) + BANDS * KINDS].copy()
        unit[len(frequent) : len(frequent) + KINDS] += 1  # words never seen can always come
        by_class = unit @ member
        self.step = transitions(np.concatenate([member.T @ m[:n] @ member, (m[n] @ member)[None]]).astype(float), by_class, beta)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.log10(unit / by_class[self.cls])
        self.classes = classes


def transitions(g: np.ndarray, by_class: np.ndarray, beta: float) -> np.ndarray:
    """log10 probability of each class after each class; the last row is the start of a text."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.log10((g + beta * by_class / by_class.sum()) / (g.sum(1, keepdims=True) + beta))


def mutual(g: np.ndarray) -> float:
    """Average mutual information of class bigrams, but for what no class changes."""
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    return float(xlogx(g).sum() - xlogx(g[:-1].sum(1)).sum() - xlogx(g.sum(0)).sum())


def moved(to: np.ndarray, frm: np.ndarray, own: np.ndarray, start: np.ndarray, old: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Best class of every unit if it alone moved.

    to, frm: its counts by the class of the word after and before it (not itself);
    own: before itself; start: at the start of a text; g: class bigrams, last row start.
    """
    n, classes = to.shape
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    u, d = np.arange(n), np.arange(classes)
    g, s = g[:classes], g[classes]
    # without the unit: class pairs (c, c), starts and sums
    pair = np.broadcast_to(g[d, d], (n, classes)).copy()
    pair[u, old] -= to[u, old] + frm[u, old] + own
    first = np.broadcast_to(s, (n, classes)).copy()
    first[u, old] -= start
    freq = frm.sum(1) + own + start
    # a neighbour's count is in its own class sum whatever class the unit has
    right, left = np.tile(g.sum(1), (n, 1)), np.tile(g.sum(0) + s, (n, 1))
    right[u, old] -= to.sum(1) + own
    left[u, old] -= freq
    gain = xlogx(pair + to + frm + own[:, None]) - xlogx(pair)
    gain += xlogx(first + start[:, None]) - xlogx(first)
    gain -= xlogx(right + (to.sum(1) + own)[:, None]) - xlogx(right)
    gain -= xlogx(left + freq[:, None]) - xlogx(left)
    for near, other, table in ((to, frm, g), (frm, to, g.T)):
        i, c = np.nonzero(near)
        for a in range(0, len(i), 1 << 16):
            r, e = i[a : a + (1 << 16)], c[a : a + (1 << 16)]
            k = near[r, e]
            base = table[:, e].T.copy()  # of every class the unit might join
            base[np.arange(len(r)), old[r]] -= k
            back = np.flatnonzero(e == old[r])
            base[back] -= other[r[back]]
            part = xlogx(base + k[:, None]) - xlogx(base)
            part[np.arange(len(r)), e] = 0  # the class pair (c, c) is counted above
            at = t.group_starts(r)
            gain[r[at]] += np.add.reduceat(part, at)
    new = gain.argmax(1)
    return np.where(gain[u, new] > gain[u, old] + 1e-9, new, old)


class Classed:
    """Tokens of one block with their units and the units' classes; ``told``: classes by the slots, or None at first.

    ``order``: the units by slot, as they are sent and answered.
    """

    def __init__(self, docs, told, seed: ClassModel, least: int, slots: int):
        self.x = x = Tokens(docs)
        self.count = x.count
        # by distinct word, each of which some token is
        band, rare = _bands(x), (x.word_count < least) & (x.words != END)
        self.units, number = np.unique(np.where(rare, RARE[band], x.words), return_inverse=True)
        self.rare, self.band, self.at = rare[x.at], band[x.at], number[x.at]
        self.cls = np.zeros(len(self.units), np.int64)
        slot = t.slot_of(self.units, slots)
        self.order = np.argsort(slot, kind="stable")
        self.slot = slot[self.order]
        if told is not None:
            by = np.argsort(t.ids(told["origin"]), kind="stable")
            self.cls[self.order] = _values(told["cls"].combine_chunks().take(pa.array(by)), _small(seed.classes))
        else:
            self.cls[self.at] = seed.cls[_units(x, seed.frequent)]
            # some words that only their band speaks for are spread, or all of a band would look alike to their neighbours
            spread = np.ones(len(self.units), bool)
            spread[number[rare | (x.words == END)]] = False
            spread &= ~t.has(seed.frequent, self.units)
            spread &= t.mix(self.units + np.uint64(1)) % np.uint64(SPREAD) == 0
            self.cls[spread] = (t.mix(self.units[spread]) % np.uint64(seed.classes)).astype(np.int64)

    def before(self, start: int) -> np.ndarray:
        """Class before every token."""
        cls = self.cls[self.at]
        out = np.empty_like(cls)
        out[1:] = cls[:-1]
        out[self.x.first] = start
        return out


def _small(values: int):
    """Least type for so many values."""
    return np.uint8 if values <= 1 << 8 else np.uint16 if values <= 1 << 16 else np.uint32


#: number of digits (of 8 bits) that have codes of their own; a longer count repeats the highest
DIGITS = 3
_CONTEXTS = "slot int, src int, hash binary, cls binary, size binary, code binary, n binary"


def _digits(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in n, digit, value of 1..255) of numbers as sums of value << 8 * digit."""
    place, digit, value = [], [], []
    for d in range(DIGITS - 1):
        v = n >> 8 * d & 255
        at = np.flatnonzero(v)
        place.append(at), digit.append(np.full(len(at), d)), value.append(v[at])
    rest = n >> 8 * (DIGITS - 1)
    times = -(-rest // 255)
    at = np.repeat(np.arange(len(n)), times)
    last = np.cumsum(times)[times > 0] - 1
    v = np.full(len(at), 255)
    v[last] = (rest - 255 * (times - 1))[times > 0]
    place.append(at), digit.append(np.full(len(at), DIGITS - 1)), value.append(v)
    return np.concatenate(place), np.concatenate(digit), np.concatenate(value)


def _contexts(sent, least: int, slots: int):
    """Of one block: its units, their classes and their counts by neighbour class, to the slots."""

    def fn(docs, told):
        if docs.num_rows == 0:
            z = np.zeros(0, np.uint8)
            return pa.table({"slot": pa.array([], pa.int32()), "src": pa.array([], pa.int32())} | {k: _blobs(z, [0]) for k in ("hash", "cls", "size", "code", "n")})
        seed: ClassModel = sent.value
        b, c = Classed(docs, told, seed, least, slots), seed.classes
        kinds = 2 * c + 2
        rank = np.empty(len(b.units), np.int64)
        rank[b.order] = np.arange(len(b.units))
        later = b.x.training.copy()
        later[b.x.first] = False
        later = np.flatnonzero(later)
        i, j = b.at[later - 1], b.at[later]
        same = i == j
        begin = b.at[b.x.first[b.x.training[b.x.first]]]
        p, q = i[~same], j[~same]
        entry = np.concatenate([rank[p] * kinds + b.cls[q], rank[q] * kinds + c + b.cls[p], rank[begin] * kinds + 2 * c, rank[i[same]] * kinds + 2 * c + 1])
        if len(b.units) * kinds <= 16 * len(entry):
            n = np.bincount(entry)
            entry = np.flatnonzero(n)
            n = n[entry]
        else:
            entry, n = np.unique(entry, return_counts=True)
        place, digit, value = _digits(n)
        unit, code = entry[place] // kinds, entry[place] % kinds + kinds * digit
        by = np.argsort(unit, kind="stable")
        size = np.bincount(unit, minlength=len(b.units))
        at = t.group_starts(b.slot)
        offs = np.concatenate([at, [len(b.units)]])
        inner = np.concatenate([[0], np.cumsum(size)])[offs]
        return pa.table({
            "slot": pa.array(b.slot[at].astype(np.int32)),
            "src": pa.array(np.full(len(at), docs["slot"][0].as_py(), np.int32)),
            "hash": _blobs(b.units[b.order], offs),
            "cls": _blobs(b.cls[b.order].astype(_small(c)), offs),
            "size": _blobs(size.astype(np.uint32), offs),
            "code": _blobs(code[by].astype(_small(kinds * DIGITS)), inner),
            "n": _blobs(value[by].astype(np.uint8), inner),
        })

    return fn


_SUMS = "slot int, hash binary, cls binary, entry array<int>, n array<bigint>, src array<int>, asked array<int>, at array<int>, g array<bigint>"


def _sum_contexts(classes: int):
    """Of one slot: its units' classes and counts by neighbour class (entries as steps), the blocks that have them, and its part of the class bigrams."""
    kinds = 2 * classes + 2

    def fn(key, table):
        units, at = np.unique(_values(table["hash"], np.uint64), return_inverse=True)
        cls = np.zeros(len(units), np.int64)
        cls[at] = _values(table["cls"], _small(classes))
        # entry, digit and value in one number: a sort alone brings equal entries together
        code = _values(table["code"], _small(kinds * DIGITS)).astype(np.int64)
        packed = ((np.repeat(at, _values(table["size"], np.uint32)) * kinds + code % kinds) * DIGITS + code // kinds) << 8
        packed |= _values(table["n"], np.uint8)
        packed.sort()
        entry = (packed >> 8) // DIGITS
        n = (packed & 255) << 8 * ((packed >> 8) - entry * DIGITS)
        g = t.group_starts(entry)
        entry, n = entry[g], np.add.reduceat(n, g) if len(g) else n
        c, code = cls[entry // kinds], entry % kinds
        g = np.zeros((classes + 1, classes), np.int64)
        after, begin, same = code < classes, code == 2 * classes, code == 2 * classes + 1
        np.add.at(g, (c[after], code[after]), n[after])
        np.add.at(g[classes], c[begin], n[begin])
        np.add.at(g, (c[same], c[same]), n[same])
        one = lambda v, kind=pa.int32(): pa.array([v], pa.list_(kind))
        return pa.table({
            "slot": pa.array([key[0].as_py()], pa.int32()),
            "hash": _blobs(units, [0, len(units)]), "cls": _blobs(cls.astype(_small(classes)), [0, len(units)]),
            "entry": one(np.diff(entry, prepend=0)), "n": one(n, pa.int64()),
            "src": one(t.ids(table["src"])), "asked": one(_sizes(table["hash"], np.uint64)), "at": one(at), "g": one(g.ravel(), pa.int64()),
        })

    return fn


#: to each block the classes of the units it sent, in its order; rare: classes of the bands (hash), in rows without a block
_CHOSEN = "slot int, origin int, cls binary, hash array<bigint>, rare array<int>"


def _choose(sent, classes: int, turn: int):
    """Of the slots' sums: to each block the new classes of its units."""
    kinds = 2 * classes + 2

    def fn(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                part = lambda name: batch.column(name)[k].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                units, old = np.frombuffer(batch.column("hash")[k].as_py(), np.uint64), np.frombuffer(batch.column("cls")[k].as_py(), _small(classes)).astype(np.int64)
                entry = np.cumsum(part("entry"), dtype=np.int64)
                n = part("n")
                new = old.copy()
                # neighbours that move at once would miss each other
                go = (t.mix(units) >> np.uint64(40)) % np.uint64(PARTS) == turn % PARTS
                step = 20_000
                for a in range(0, len(units), step):
                    lo, hi = np.searchsorted(entry, [a * kinds, (a + step) * kinds])
                    x = np.zeros((min(step, len(units) - a), kinds))
                    x.ravel()[entry[lo:hi] - a * kinds] = n[lo:hi]
                    u = np.flatnonzero(go[a : a + step])
                    x, u = x[u], u + a
                    new[u] = moved(x[:, :classes], x[:, classes : 2 * classes], x[:, 2 * classes + 1], x[:, 2 * classes], old[u], sent.value)
                src, asked = part("src"), part("asked")
                band = np.isin(units, RARE)
                rows = len(src)
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array(np.append(src, -1).astype(np.int32)),
                    "origin": pa.array(np.full(rows + 1, batch.column("slot")[k].as_py(), np.int32)),
                    "cls": _blobs(new[part("at")].astype(_small(classes)), np.concatenate([[0], np.cumsum(asked), [asked.sum()]])),
                    "hash": pa.array([[]] * rows + [units[band].view(np.int64)], pa.list_(pa.int64())),
                    "rare": pa.array([[]] * rows + [new[band]], pa.list_(pa.int32())),
                })

    return fn


def _class_bigrams(sent, least: int, slots: int):
    """Of one block: its part of the class bigrams."""

    def fn(docs, told):
        if docs.num_rows == 0:
            return pa.table({"pos": pa.array([], pa.int64()), "col": pa.array([], pa.int64())})
        seed: ClassModel = sent.value
        b = Classed(docs, told, seed, least, slots)
        pos, n = np.unique((b.before(seed.classes) * seed.classes + b.cls[b.at])[b.x.training], return_counts=True)
        return pa.table({"pos": pa.array(pos.astype(np.int64)), "col": pa.array(n.astype(np.int64))})

    return fn


def _matrix(parts: DataFrame, classes: int) -> np.ndarray:
    """Sum of the parts (pos, col) of the class bigrams."""
    g = np.zeros((classes + 1) * classes)
    for r in parts.groupBy("pos").agg(F.sum("col").alias("n")).collect():
        g[r.pos] = r.n
    return g.reshape(classes + 1, classes)


class WordModel:
    """Smoothed class transitions, and what classes and bands emit."""

    def __init__(self, seed: ClassModel, g: np.ndarray, rare: dict[int, int], beta: float):
        f = len(seed.frequent)
        self.seed = seed
        by_class = g.sum(0)
        band_cls = seed.cls[f : f + BANDS * KINDS].copy()
        for i, h in enumerate(RARE.view(np.int64).tolist()):
            band_cls[i] = rare.get(h, band_cls[i])
        np.add.at(by_class, band_cls[:KINDS], 1)  # words never seen can always come
        self.step = transitions(g, by_class, beta)
        band = seed.band.copy()
        band[:KINDS] += 1
        self.band_cls = band_cls
        with np.errstate(divide="ignore"):
            self.by_class, self.band = np.log10(by_class), np.log10(band)

    def score(self, b: Classed) -> np.ndarray:
        """log10 probability of every token."""
        # a band that no training text has is in no table: it emits words never seen from its seed's class
        cls = np.where(b.rare, self.band_cls[b.band], b.cls[b.at])
        before = np.empty_like(cls)
        before[1:] = cls[:-1]
        before[b.x.first] = self.seed.classes
        p = self.step[before, cls] - self.by_class[cls]
        seen = np.log10(np.maximum(b.count, 1))
        once = b.rare & (b.band < KINDS)
        # words seen once share half of their band (its count less the one added), words never seen have the other half
        alone = np.where(b.count > 0, np.log10(0.5) - np.log10(np.maximum(10 ** self.band[b.band] - 1, 1)), np.log10(0.5))
        return p + np.where(once, self.band[b.band] + alone, seen)


def _score(model, least: int, slots: int):
    def fn(docs, told):
        net: WordModel = model.value
        seed = net.seed
        b = Classed(docs, told, seed, least, slots)
        x, count = b.x, b.count
        n = len(x.doc_id)
        by_row = lambda v: np.bincount(x.row, v, n)
        base = np.log10((count + 1) / (seed.tokens + seed.words + 1))
        score = net.score(b) if seed.tokens else np.zeros(len(count))
        return pa.table({
            "doc_id": pa.array(x.doc_id),
            "held_out": pa.array(~x.training[x.first]),
            "n_tokens": pa.array(x.size.astype(np.int64)),
            "n_known": pa.array(by_row(count > 0).astype(np.int64)),
            "train_tokens": pa.array(np.full(n, seed.tokens, np.int64)),
            "base_score": pa.array(by_row(base)),
            "score": pa.array(by_row(score)),
        })

    return fn


def class_lm_scores(
    docs: DataFrame, share: float = SHARE, classes: int = CLASSES, sweeps: int = SWEEPS, beta: float = BETA, block_bytes: int = BLOCK, least: int = LEAST, rounds: int = ROUNDS
) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), and its perplexity."""
    blocks, _, slots = in_blocks(docs, block_bytes)
    schema = "slot int, origin int, hash array<bigint>, count array<bigint>, tokens long, words long"
    asked = blocks.groupBy("block").applyInArrow(_ask(slots), "slot int, src int, hash array<bigint>, count array<bigint>")
    totals = written(asked.groupBy("slot").applyInArrow(_totals(share), schema), "lm-counts", "zstd", free=True)
    summary = totals.where("slot = -1")
    tokens, words = summary.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    often = summary.select(F.explode(F.arrays_zip("hash", "count")).alias("w")).where(F.col("w.count") >= share * tokens).select("w.hash")
    # at most 1 / share words
    frequent = np.sort(np.array([r[0] for r in often.collect()], np.int64).view(np.uint64))
    counts = totals.where("slot >= 0").select("slot", "origin", "count")
    tokenised = blocks.groupBy("block").cogroup(counts.groupBy("slot")).applyInArrow(_tokens(frequent, least, slots), _TOKENS)
    table = written(tokenised, "lm-tokens", "zstd", free=True)
    remove(totals)
    n_units = len(frequent) + BANDS * KINDS + 1
    pairs = table.groupBy("slot").applyInArrow(_bigrams(frequent, slots), "slot int, src int, pair array<bigint>, count array<bigint>")
    # at most the square of the number of units
    summed = written(pairs.groupBy("slot").applyInArrow(_sum_pairs, "pair long, count long"), "lm-pairs", "zstd", free=True)
    counted = summed.toArrow()
    remove(summed)
    m = np.zeros((n_units + 1) * n_units, np.int64)
    m[counted["pair"].to_numpy()] = counted["count"].to_numpy()
    seed = ClassModel(m.reshape(n_units + 1, n_units), frequent, int(tokens), int(words), classes, sweeps, beta)

    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(seed)

    def of_blocks(fn, chosen, schema):
        """fn of every block and what it was told."""
        if chosen is None:
            return table.groupBy("slot").applyInArrow(lambda docs: fn(docs, None), schema)
        told = chosen.where("slot >= 0").select("slot", "origin", "cls")
        return table.groupBy("slot").cogroup(told.groupBy("slot")).applyInArrow(fn, schema)

    kept, chosen, g, best = None, None, np.zeros((classes + 1, classes)), -np.inf
    rounds = rounds if tokens else 0
    for turn in range(rounds + 1):
        sums = None
        if turn < rounds:
            sums = of_blocks(_contexts(sent, least, slots), chosen, _CONTEXTS)
            sums = written(sums.groupBy("slot").applyInArrow(_sum_contexts(classes), _SUMS), "lm-contexts", "zstd", free=True)
            parts = sums.select(F.posexplode("g").alias("pos", "col"))
        else:
            parts = written(of_blocks(_class_bigrams(sent, least, slots), chosen, "pos long, col long"), "lm-bigrams", "zstd", free=True)
        now = _matrix(parts, classes)
        if sums is None:
            remove(parts)
        better = not turn or mutual(now) > best
        if better:
            if kept is not None:
                remove(kept)
            kept, g, best = chosen, now, mutual(now)
            if turn < rounds:
                chosen = written(sums.mapInArrow(_choose(spark.sparkContext.broadcast(g), classes, turn), _CHOSEN), "lm-classes", "zstd")
        else:
            remove(chosen)
        if sums is not None:
            remove(sums)
        if not better:
            break

    rare = {}
    if kept is not None:
        units = RARE[: int(np.log2(least)) * KINDS].view(np.int64).tolist()
        bands = kept.where("slot = -1").select(F.explode(F.arrays_zip("hash", "rare")).alias("w")).select("w.hash", "w.rare")
        rare = {r.hash: r.rare for r in bands.where(F.col("hash").isin(units)).collect()}
    model = spark.sparkContext.broadcast(WordModel(seed, g, rare, beta))
    out = of_blocks(
        _score(model, least, slots), kept, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class bigram and base score of every document."""
    return class_lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
