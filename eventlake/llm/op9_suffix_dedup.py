"""Suffix-array dedup by prefix-free parsing.

Texts are UTF-8 bytes. A byte goes if it lies in a ``width``-byte string that
also starts in a document with a smaller doc_id. Method:

1. Parse: the trigger of a string is the least rolling hash of its ``k``-byte
   runs. Neighbouring strings share their trigger, so a text falls into phrases,
   each with its look-ahead of ``width`` bytes: no phrase is a prefix of another
   one's text by accident, and equal strings always lie in phrases of one trigger.
   Phrases whose trigger occurs in one document only cannot repeat.
2. Dictionary: the distinct phrases of a trigger, with the smallest doc_id that
   has each, meet in one slot (once per block that has them). If a trigger has
   one phrase only, its strings belong to that doc_id. Else the phrases' bytes
   are brought too, and the suffix array of the dictionary puts their suffixes in
   order of the first ``width`` bytes; equal neighbours are one string, owned by
   its smallest doc_id.
3. The parse, kept by the blocks, carries the owners back to every place of a
   phrase: what a smaller doc_id owns is removed.

A trigger that more than ``hot`` blocks have is split: each of its strings goes
by its own hash to a slot, at most once per block, so no slot receives an
unbounded group. Only phrase look-ahead of ``width`` bytes is sorted, instead of
a suffix array of the whole parse: longer order cannot change the result.

Null and empty texts have no bytes and no spans; rows that share a doc_id never
remove each other's bytes; rows without doc_id are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.blocks import distinct_per_doc, in_blocks

WIDTH = 50
RUN = 28
HOT = 64
BLOCK = 1 << 20
AT_ONCE = 200_000
_NONE = np.zeros(0, np.int64)
_LOW = np.uint64(0xFFFFFFFF)


def _short(h: np.ndarray) -> np.ndarray:
    """32 bits of a hash; triggers are the same to all blocks if their slots, which other bits choose, are too."""
    return (h & _LOW).astype(np.uint32).view(np.int32)


def _name(trigger: np.ndarray, slots: int) -> np.ndarray:
    """Slot and 32 bits of a trigger, as the slots tell them apart."""
    return t.slot_of(trigger, slots).astype(np.uint64) << np.uint64(32) | trigger & _LOW


def _number(table: pa.Table, name: str) -> pa.Table:
    """Lists of flags whose ones lead, as the number of ones."""
    total = np.concatenate([[0], np.cumsum(t.longs(table[name]).astype(np.int64))])
    size = t.lengths(table[name])
    stop = np.cumsum(size)
    return table.set_column(table.schema.get_field_index(name), name, pa.array((total[stop] - total[stop - size]).astype(np.int32)))


def _flags(table: pa.Table, name: str, size: np.ndarray) -> np.ndarray:
    """The flags of :func:`_number` again, for lists of these sizes."""
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return at < np.repeat(t.ids(table[name]), size)


def _packed(ids: np.ndarray) -> tuple[int, dict[str, np.ndarray]]:
    """ids as a base and what they have above it: 32 bits, and the next 32 if any id needs them."""
    base = int(ids.min()) if len(ids) else 0
    above = ids.view(np.uint64) - np.array(base, np.int64).view(np.uint64)
    high = (above >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return base, {"doc": _short(above)} | ({"high": high} if high.any() else {})


def _sent(slots: np.ndarray, src: int, ids: np.ndarray, arrays: dict[str, np.ndarray], optional: tuple[str, ...] = ()) -> pa.Table:
    """:func:`textops.dealt` with packed ids; ``optional`` lists that are not given are empty."""
    base, packed = _packed(ids)
    out = t.dealt(slots, src, arrays | packed)
    out = out.append_column("base", pa.array(np.full(out.num_rows, base, np.int64)))
    for name in ("high", *optional):
        if name not in out.column_names:
            out = out.append_column(name, pa.array([[]] * out.num_rows, pa.list_(pa.int32())))
    return out


def _given(table: pa.Table, name: str, size: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    """Values of optional lists; ``otherwise`` where a row has none."""
    out = otherwise.copy()
    out[np.repeat(t.lengths(table[name]) > 0, size)] = t.longs(table[name])
    return out


def _unpacked(table: pa.Table) -> np.ndarray:
    size = t.lengths(table["doc"])
    high = _given(table, "high", size, np.zeros(size.sum(), np.uint64))
    return (np.repeat(t.ids(table["base"]), size).view(np.uint64) + (t.longs(table["doc"]) & _LOW | high << np.uint64(32))).view(np.int64)


class Phrases:
    """Phrases of one block: trigger, first and last start of their strings, document."""

    def __init__(self, table, width: int, run: int):
        self.doc_id = t.ids(table["doc_id"])
        self.buf, self.offs = t.text_bytes(table["text"])
        self.width = width
        n = len(self.buf) - width + 1
        z = np.zeros(0, np.int64)
        self.trigger, self.first, self.last, self.row = np.zeros(0, np.uint64), z, z, z
        if n > 0:
            at = np.arange(len(self.buf) - run + 1)
            least = t.sliding_min(t.span_hash(self.buf, at, at + run), width - run + 1)
            row = np.repeat(np.arange(len(self.doc_id)), np.diff(self.offs))
            ok = np.flatnonzero(row[:n] == row[width - 1 :])
            if len(ok):
                value, r = least[ok], row[ok]
                new = np.ones(len(ok), bool)
                new[1:] = (value[1:] != value[:-1]) | (r[1:] != r[:-1]) | (np.diff(ok) != 1)
                a = np.flatnonzero(new)
                self.trigger, self.row, self.first = value[a], r[a], ok[a]
                self.last = ok[np.concatenate([a[1:], [len(ok)]]) - 1]
        self.doc = self.doc_id[self.row]

    def triggers(self):
        return distinct_per_doc(self.trigger, self.doc)

    def recurring(self, told: np.ndarray, hot: np.ndarray, slots: int):
        """(route, key, row, first, last, hot) of the phrases that can repeat; those of hot triggers split into single strings."""
        own, multi = self.triggers()
        at = np.flatnonzero(t.has(np.sort(own[multi]), self.trigger) | t.has(np.sort(told), _name(self.trigger, slots)))
        trigger, row, first, last = self.trigger[at], self.row[at], self.first[at], self.last[at]
        is_hot = t.has(np.sort(hot), _name(trigger, slots))
        size = np.where(is_hot, last - first + 1, 1)
        each = np.repeat(np.arange(len(at)), size)
        step = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
        first, last, row = first[each] + step, np.where(is_hot[each], first[each] + step, last[each]), row[each]
        body = t.span_hash(self.buf, first, last + self.width)
        route = np.where(is_hot[each], body, trigger[each])
        return route, t.mix(body ^ (route * np.uint64(3))), row, first, last, is_hot[each]


def _ask(width: int, run: int, slots: int):
    def fn(key, docs):
        own, multi = Phrases(docs, width, run).triggers()
        own, multi = (x[np.argsort(~multi, kind="stable")] for x in (own, multi))
        return _number(t.dealt(t.slot_of(own, slots), key[0].as_py(), {"hash": _short(own), "multi": multi.astype(np.int8)}), "multi")

    return fn


def _answer(hot: int):
    """Of one slot: to each block, which of its triggers recur elsewhere, and which are hot."""

    def fn(key, table):
        size = t.lengths(table["hash"])
        h, multi = t.longs(table["hash"]), _flags(table, "multi", size)
        src = np.repeat(t.ids(table["src"]), size)
        order = np.argsort(h)
        h, multi, src = h[order], multi[order], src[order]
        g = t.group_starts(h)
        size = np.diff(np.concatenate([g, [len(h)]]))
        again = np.repeat((size > 1) | np.logical_or.reduceat(multi, g), size) if len(g) else np.zeros(0, bool)
        many = np.repeat(size > hot, size)
        tell = np.concatenate([np.flatnonzero(many), np.flatnonzero(again & ~multi & ~many)])
        out = t.dealt(src[tell], key[0].as_py(), {"hash": _short(h[tell]), "hot": many[tell].astype(np.int8)})
        return _number(out.rename_columns(["slot", "origin", "hash", "hot"]), "hot")

    return fn


def _hot_of(told):
    size = t.lengths(told["hash"])
    origin = np.repeat(t.ids(told["origin"]), size).astype(np.uint64)
    hashes = origin << np.uint64(32) | t.longs(told["hash"]) & _LOW
    return hashes, hashes[_flags(told, "hot", size)]


def _of(told, kind: int):
    """The rows of one kind that a block was told."""
    return told.filter(pa.array(t.ids(told["kind"]) == kind))


def _claim(width: int, run: int, slots: int):
    """Of one block: its distinct recurring phrases by hash, with their smallest doc_id, to the slots.

    A string of a hot trigger has its route from itself, so none is sent.
    """

    def fn(docs, told):
        p = Phrases(docs, width, run)
        route, key, row, _, _, hot = p.recurring(*_hot_of(told), slots)
        order = np.argsort(key)
        g = t.group_starts(key[order])
        least = np.minimum.reduceat(p.doc_id[row[order]], g) if len(g) else _NONE
        route, key, hot = route[order][g], key[order][g], hot[order][g]
        slot, block = t.slot_of(t.mix(route), slots), docs["block"][0].as_py() if docs.num_rows else 0
        parts = []
        for part, own in ((~hot, {"route": _short(route[~hot])}), (hot, {})):
            out = _sent(slot[part], block, least[part], own | {"key": key[part]}, ("route",))
            parts.append(out.select(["slot", "src", "route", "key", "doc", "high", "base"]))
        return pa.concat_tables(parts)

    return fn


def _settle(table):
    """Of one slot: to each block, the owner of phrases that are alone with their trigger (kind 1), or that the bytes are needed (kind 2)."""
    key, doc, size = t.longs(table["key"]), _unpacked(table), t.lengths(table["key"])
    route = _given(table, "route", size, key)  # a string of a hot trigger is alone with its route
    src = np.repeat(t.ids(table["src"]), size)
    order = np.lexsort((doc, key, route))
    route, key, doc, src = route[order], key[order], doc[order], src[order]
    g = t.group_starts(route, key)
    if len(g) == 0:
        alone, least = np.zeros(0, bool), doc
    else:
        size = np.diff(np.concatenate([g, [len(key)]]))
        least = np.repeat(doc[g], size)
        r = t.group_starts(route[g])
        phrases = np.diff(np.concatenate([r, [len(g)]]))
        alone = np.repeat(np.repeat(phrases == 1, phrases), size)
    told = []
    for kind, tell in ((1, alone & (least < doc)), (2, ~alone)):
        out = _sent(src[tell], kind, least[tell], {"hash": key[tell]})
        told.append(out.select(["slot", "src", "hash", "doc", "high", "base"]).rename_columns(["slot", "kind", "hash", "doc", "high", "base"]))
    return pa.concat_tables(told)


def _gather(buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.cumsum(size)
    return buf[np.repeat(first - at + size, size) + np.arange(at[-1])] if len(size) else buf[:0]


def _dictionary(width: int, run: int, slots: int):
    """Of one block: the phrases whose bytes are needed, with their smallest doc_id, to the slots."""

    def fn(docs, told):
        block = docs["block"][0].as_py() if docs.num_rows else 0
        p = Phrases(docs, width, run)
        route, key, row, first, last, _ = p.recurring(*_hot_of(_of(told, 0)), slots)
        wanted = t.has(np.sort(t.longs(_of(told, 2)["key"])), key)
        route, key, row, first, last = route[wanted], key[wanted], row[wanted], first[wanted], last[wanted]
        order = np.argsort(key)
        g = t.group_starts(key[order])
        least = np.minimum.reduceat(p.doc_id[row[order]], g) if len(g) else _NONE
        one = order[g]
        slot = t.slot_of(t.mix(route[one]), slots)
        by = np.argsort(slot, kind="stable")
        one, least = one[by], least[by]
        size = last[one] - first[one] + width
        out = _sent(slot[by], block, least, {"route": route[one], "key": key[one], "size": size.astype(np.int32)})
        out = out.select(["slot", "src", "route", "key", "doc", "high", "base", "size"])
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(t.lengths(out["key"]))]).astype(int)] if len(one) else np.zeros(1, int)
        return out.append_column("data", t.strings(_gather(p.buf, first[one], size), ends, binary=True))

    return fn


def _suffix_order(data: np.ndarray, starts: np.ndarray, width: int):
    """Suffix array of the given places by their first ``width`` bytes, and where a new string begins in it."""
    eights = -(-width // 8)
    m = np.zeros((len(starts), eights * 8), np.uint8)
    m[:, :width] = data[starts[:, None] + np.arange(width)]
    words = m.view(">u8")
    order = np.lexsort(tuple(words[:, j] for j in range(eights - 1, -1, -1)))
    s = words[order]
    new = np.ones(len(starts), bool)
    new[1:] = (s[1:] != s[:-1]).any(1)
    return order, np.flatnonzero(new)


def _owners(width: int):
    """Of one slot: to each block, the strings of its phrases (first, last place) that a smaller doc_id elsewhere owns."""

    def fn(table):
        route, key, doc, size = t.longs(table["route"]), t.longs(table["key"]), _unpacked(table), t.longs(table["size"]).view(np.int64)
        src = np.repeat(t.ids(table["src"]), t.lengths(table["key"]))
        data, _ = t.text_bytes(table["data"])
        start = np.cumsum(size) - size
        order = np.lexsort((doc, key, route))
        route, key, doc, size, src, start = route[order], key[order], doc[order], size[order], src[order], start[order]
        g = t.group_starts(route, key)  # the dictionary: its first entry has the smallest doc_id
        entry = np.repeat(np.arange(len(g)), np.diff(np.concatenate([g, [len(key)]])))
        out_entry, out_from, out_to, out_owner = [], [], [], []
        if len(g):
            rg = t.group_starts(route[g])
            rsize = np.diff(np.concatenate([rg, [len(g)]]))
            single = np.repeat(rsize == 1, rsize)
            alone = np.flatnonzero(single)
            out_entry.append(alone)
            out_from.append(np.zeros(len(alone), np.int64))
            out_to.append(size[g][alone] - width)
            out_owner.append(doc[g][alone])
            # several phrases of one trigger: sort their suffixes, whole triggers at a time
            many = np.flatnonzero(~single)
            count = size[g][many] - width + 1
            group = np.cumsum(np.concatenate([[True], np.diff(route[g][many].view(np.int64)) != 0])) if len(many) else _NONE
            upto = np.cumsum(count)
            a = 0
            while a < len(many):
                b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + AT_ONCE, "right"))
                b = int(np.searchsorted(group, group[max(a, min(b, len(many) - 1))], "right"))
                e, c = many[a:b], count[a:b]
                who = np.repeat(np.arange(len(e)), c)
                off = np.arange(len(who)) - np.repeat(np.cumsum(c) - c, c)
                order, new = _suffix_order(data, start[g][e][who] + off, width)
                least = np.repeat(np.minimum.reduceat(doc[g][e][who][order], new), np.diff(np.concatenate([new, [len(order)]])))
                owner = np.empty(len(order), np.int64)
                owner[order] = least
                run = t.group_starts(who, owner)
                out_entry.append(e[who[run]])
                out_from.append(off[run])
                out_to.append(off[np.concatenate([run[1:], [len(who)]]) - 1])
                out_owner.append(owner[run])
                a = b
        cat = lambda x: np.concatenate(x) if x else _NONE
        e, lo, hi, owner = cat(out_entry), cat(out_from), cat(out_to), cat(out_owner)
        by = np.argsort(e, kind="stable")
        e, lo, hi, owner = e[by], lo[by], hi[by], owner[by]
        # join the runs of an entry with all blocks that have it
        first, stop = np.searchsorted(e, entry, "left"), np.searchsorted(e, entry, "right")
        n = stop - first
        each = np.repeat(np.arange(len(entry)), n)
        at = np.repeat(first, n) + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        tell = owner[at] < doc[each]
        each, at = each[tell], at[tell]
        out = _sent(src[each], 0, owner[at], {"hash": key[each], "lo": lo[at].astype(np.int32), "hi": hi[at].astype(np.int32)})
        return out.select(["slot", "hash", "lo", "hi", "doc", "high", "base"])

    return fn


def _remove(width: int, run: int, slots: int):
    def fn(docs, told):
        p = Phrases(docs, width, run)
        _, key, row, first, last, _ = p.recurring(*_hot_of(_of(told, 0)), slots)
        alone, many = _of(told, 1), _of(told, 3)
        whole = t.longs(alone["key"])
        told_key = np.concatenate([whole, t.longs(many["key"])])
        owner = np.concatenate([_unpacked(x) for x in (alone, many)])
        lo = np.concatenate([np.zeros(len(whole), np.int64), t.longs(many["lo"]).view(np.int64)])
        hi = np.concatenate([np.full(len(whole), -1), t.longs(many["hi"]).view(np.int64)])  # -1: to the phrase's end
        doc = p.doc_id[row]
        # in the block itself
        order = np.argsort(key)
        g = t.group_starts(key[order])
        least = np.empty(len(key), np.int64)
        if len(g):
            least[order] = np.repeat(np.minimum.reduceat(doc[order], g), np.diff(np.concatenate([g, [len(key)]])))
        mine = np.flatnonzero(least < doc)
        begin, stop = [first[mine]], [last[mine] + width]
        # as told by the slots
        by = np.argsort(told_key)
        a, b = np.searchsorted(told_key[by], key, "left"), np.searchsorted(told_key[by], key, "right")
        n = b - a
        each = np.repeat(np.arange(len(key)), n)
        at = by[np.repeat(a, n) + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)]
        ok = owner[at] < doc[each]
        each, at = each[ok], at[ok]
        begin.append(first[each] + lo[at])
        stop.append(np.where(hi[at] < 0, last[each], first[each] + hi[at]) + width)
        begin, stop = np.concatenate(begin), np.concatenate(stop)
        size = len(p.buf)
        go = t.covered(begin, stop - begin, size)
        rows = len(p.doc_id)
        n_bytes = np.diff(p.offs)
        row_of = np.repeat(np.arange(rows), n_bytes)
        starts = go.copy()
        starts[1:] &= ~go[:-1] | (row_of[1:] != row_of[:-1])
        removed = np.bincount(row_of[go], minlength=rows)
        return pa.table({
            "doc_id": pa.array(p.doc_id),
            "n_bytes": pa.array(n_bytes.astype(np.int64)),
            "n_removed": pa.array(removed.astype(np.int64)),
            "n_spans": pa.array(np.bincount(row_of[starts], minlength=rows).astype(np.int64)),
            "kept": t.strings(p.buf[~go], np.concatenate([[0], np.cumsum(n_bytes - removed)]), binary=True),
        })

    return fn


def suffix_dedup(docs: DataFrame, width: int = WIDTH, run: int = RUN, hot: int = HOT, block_bytes: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of every row of ``docs`` (doc_id, text)."""
    blocks, _, slots = in_blocks(docs, block_bytes)
    by_block = blocks.groupBy("block")
    none = F.array().cast("array<int>")
    short = [F.lit(-1).alias("origin"), none.alias("hash"), F.lit(0).alias("hot")]
    packed = "doc array<int>, high array<int>, base bigint"

    def told(kind, rows, *known):
        """Answers of one kind in the common form of all."""
        have = {c: F.col(c) for c in known}
        key = have.get("hash") if kind else None
        first = short if kind else ["origin", "hash", "hot"]
        lists = [have.get(c, none).alias(c) for c in ("lo", "hi", "doc", "high")]
        return rows.select("slot", F.lit(kind).alias("kind"), *first, (F.array().cast("array<bigint>") if key is None else key).alias("key"), *lists, have.get("base", F.lit(0).cast("bigint")).alias("base"))

    asked = by_block.applyInArrow(_ask(width, run, slots), "slot int, src int, hash array<int>, multi int")
    answers = asked.groupBy("slot").applyInArrow(_answer(hot), "slot int, origin int, hash array<int>, hot int")
    claims = by_block.cogroup(answers.groupBy("slot")).applyInArrow(_claim(width, run, slots), f"slot int, src int, route array<int>, key array<bigint>, {packed}")
    settled = claims.groupBy("slot").applyInArrow(_settle, f"slot int, kind int, hash array<bigint>, {packed}")
    recurring = told(0, answers)
    needed = recurring.unionAll(told(2, settled.where("kind = 2"), "hash"))
    dictionary = by_block.cogroup(needed.groupBy("slot")).applyInArrow(
        _dictionary(width, run, slots), f"slot int, src int, route array<bigint>, key array<bigint>, {packed}, size array<int>, data binary"
    )
    owned = dictionary.groupBy("slot").applyInArrow(_owners(width), f"slot int, hash array<bigint>, lo array<int>, hi array<int>, {packed}")
    final = recurring.unionAll(told(1, settled.where("kind = 1"), "hash", "doc", "high", "base")).unionAll(told(3, owned, "hash", "lo", "hi", "doc", "high", "base"))
    return by_block.cogroup(final.groupBy("slot")).applyInArrow(_remove(width, run, slots), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that an earlier document has."""
    out = suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
