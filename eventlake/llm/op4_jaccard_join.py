"""N-gram Jaccard join by universe-partition pigeonhole.

A document's set holds its distinct five-word shingles (as 64-bit hashes); two
documents link when 100 * intersection >= 75 * union. Method:

1. Equal sets are one class (128-bit fingerprint); the least doc_id stands for it.
2. A class can only have a partner if at most a quarter of its shingles are its
   own; a fixed share of the shingle universe is counted over all documents and
   classes with more shingles of their own than that are left out (sound).
3. Sizes are in bands of ratio two. For the larger size u of a band, linked sets
   differ in at most H = floor(2u / 7) shingles, so hashing the universe into
   m = H + 1 + slack segments leaves more than ``slack`` segments where they
   agree. The subset of a set in each non-empty segment is a key (a set in the
   top quarter of a band is also keyed for the next band). Groups of one key are
   candidates.
4. Allocation by cost: a key with more than ``crowd`` classes only links them to
   its least one. A set whose segments are empty or crowded more often than its
   slack allows is not covered by its exact keys; between such sets the segments
   are keyed again with their one-deletion neighbourhoods (two differences a
   segment are needed to miss them). What even that does not cover is compared
   through its rarest shingles (prefix filter), which needs no key group at all:
   first with a few sets chosen by hash, which connects crowds of near copies,
   then with every set that is still apart from it.
5. A parity sketch of each set (bit = parity of the shingles hashed to it) bounds
   the difference from below: two sets differ in at least as many shingles as
   their sketches in bits, so most candidates go without their texts being moved
   (sound); long sets, which fill a sketch, are also compared by a wider one. The
   others are verified exactly on their whole sets. Sets that are
   already connected are not compared again: a component needs no further link.

Null and empty texts have the empty set: n_shingles 0, their own component.
Rows that share a doc_id are one node. Rows without doc_id are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.blocks import ASKED, BLOCK_BYTES, TOLD, distinct_per_doc, in_blocks, recurring
from eventlake.llm.components import components, remove, written

SHINGLE = 5
CROWD = 32
#: share of the shingle universe that is counted in step 2 (must exceed a quarter)
COUNTED = 0.32
SKETCH = 2048
#: sets of more shingles than LONG fill that sketch: they have one of WIDE bits besides
LONG, WIDE = 1024, 16384
#: comparisons of a crowded set in one turn, and turns, before all that is left is compared
PIVOTS, TURNS = 4, 2
#: sets of one shingle that meet in one list, at most twice as many
PART = 1024
_COUNTED_BELOW = np.uint64(int(COUNTED * 2**64))


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every row's distinct shingles, ordered by both."""
    buf, offs = t.text_bytes(column)
    buf = t.lower_ascii(buf)
    starts, ends, row = t.words(buf, offs)
    wh = t.span_hash(buf, starts, ends)
    n = len(wh) - SHINGLE + 1
    at = np.flatnonzero(row[: max(0, n)] == row[SHINGLE - 1 :]) if n > 0 else np.zeros(0, np.int64)
    h, r = t.gram_hash(wh, SHINGLE)[at] if n > 0 else np.zeros(0, np.uint64), row[at]
    count = np.bincount(row, minlength=len(offs) - 1)
    for k in range(1, SHINGLE):  # fewer words than a shingle: the whole sequence
        short = np.flatnonzero(count == k)
        if len(short):
            first = np.searchsorted(row, short)
            h = np.concatenate([h, t.mix(t.gram_hash(wh, k)[first] + np.uint64(k))])
            r = np.concatenate([r, short])
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    g = t.group_starts(h, r)
    return r[g], h[g]


def _sizes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and two fingerprints of each row's set."""

    def fn(batches):
        for batch in batches:
            t.release()
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs):
                row, h = shingle_sets(batch.column("text").slice(a, b - a))
                n = b - a
                g = t.group_starts(row)
                f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                if len(g):
                    f1[row[g]] = np.add.reduceat(h, g)
                    f2[row[g]] = np.add.reduceat(t.mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), g)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, n), "n_shingles": pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                    "f1": pa.array(f1.view(np.int64)), "f2": pa.array(f2.view(np.int64)),
                })

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(fn, "doc_id long, n_shingles long, f1 long, f2 long")


def _representatives(docs, chosen):
    """Rows of a block whose doc_id is chosen, once each."""
    ids = t.ids(docs["doc_id"])
    first = np.zeros(len(ids), bool)
    first[np.unique(ids, return_index=True)[1]] = True
    at = np.flatnonzero(first & t.has(np.sort(chosen), ids))
    return ids[at], docs["text"].combine_chunks().take(pa.array(at)) if len(at) else pa.array([], pa.string())


def _ask(slots: int):
    def fn(docs, told):
        ids, text = _representatives(docs, t.longs(told["hash"]).view(np.int64))
        row, h = shingle_sets(text)
        use = h < _COUNTED_BELOW
        own, multi = distinct_per_doc(h[use], ids[row[use]])
        block = docs["block"][0].as_py() if docs.num_rows else 0
        return t.dealt(t.slot_of(t.mix(own), slots), block, {"hash": own, "multi": multi.astype(np.int64)})

    return fn


def sketches(row: np.ndarray, h: np.ndarray, n_rows: int, bits: int = SKETCH) -> np.ndarray:
    """Parity sketch of every row's set, so many bits as 64-bit integers."""
    bit = (t.mix(h) >> np.uint64(20)) % np.uint64(bits)
    odd = np.bincount(row * bits + bit.astype(np.int64), minlength=n_rows * bits).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n_rows, bits), axis=1, bitorder="little").view(np.int64)


def wide_sketches(row: np.ndarray, h: np.ndarray, n_rows: int) -> pa.Array:
    """Sketch of WIDE bits of every row's set of more than LONG shingles, empty for others; rows in order."""
    long = np.bincount(row, minlength=n_rows) > LONG
    start = np.searchsorted(row, np.arange(n_rows + 1))
    one = [sketches(row[start[r] : start[r + 1]] * 0, h[start[r] : start[r + 1]], 1, WIDE).ravel() for r in np.flatnonzero(long).tolist()]
    offs = np.concatenate([[0], np.cumsum(long * (WIDE // 64))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate([np.zeros(0, np.int64), *one])))


def _keep(docs, told):
    """Classes that share enough shingles with others to have a partner."""
    t.release()
    kind = t.ids(told["kind"])
    pick = lambda k: t.longs(told.filter(pa.array(kind == k))["hash"])
    ids, text = _representatives(docs, pick(0).view(np.int64))
    row, h = shingle_sets(text)
    n = np.bincount(row, minlength=len(ids))
    use = h < _COUNTED_BELOW
    own, multi = distinct_per_doc(h[use], ids[row[use]])
    shared = t.has(np.sort(np.concatenate([own[multi], pick(1)])), h[use])
    alone = np.bincount(row[use][~shared], minlength=len(ids))
    at = np.flatnonzero((4 * alone <= n) & (n >= 3))
    place = np.full(len(ids), -1)
    place[at] = np.arange(len(at))
    mine = place[row] >= 0
    sketch = sketches(place[row[mine]], h[mine], len(at))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(sketch.ravel()), SKETCH // 64).cast(pa.list_(pa.int64()))
    return pa.table({"doc_id": pa.array(ids[at]), "n": pa.array(n[at].astype(np.int64)), "sketch": lists, "wide": wide_sketches(place[row[mine]], h[mine], len(at)), "text": text.take(pa.array(at))})


def _schemes(n: np.ndarray):
    """For each set size and each band it is keyed for: (rows, flag, band, segments, slack left for partners of this size)."""
    band = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    out = []
    for flag in (0, 1):
        b = band + flag
        largest = (1 << (b + 1)) - 1
        rows = np.flatnonzero((n > 0) if flag == 0 else (4 * n >= 3 * (1 << b)))
        h = 2 * largest // 7
        m = h + 3 + (16 * h + 99) // 100
        differ = np.minimum(h, (n + 4 * n // 3) // 7)
        out.append((rows, flag, b[rows], m[rows], (m - differ - 1)[rows], differ[rows]))
    return out


def _segment_keys(row: np.ndarray, h: np.ndarray, n_rows: int, deletions: bool):
    """Per scheme: (flag, row, segment, key) of every non-empty segment subset; with deletions also of its one-deletion subsets."""
    n = np.bincount(row, minlength=n_rows)
    for rows, flag, band, m, slack, differ in _schemes(n):
        at = np.full(n_rows, -1)
        at[rows] = np.arange(len(rows))
        pick = at[row] >= 0
        r, x = at[row[pick]], h[pick]
        salt = t.mix(band.astype(np.uint64))
        spread = t.mix(x ^ salt[r])
        seg = (spread % m[r].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((seg, r))
        r, seg, spread = r[order], seg[order], t.mix(spread[order] ^ np.uint64(0x5BD1E995))
        g = t.group_starts(r, seg)
        size = np.diff(np.concatenate([g, [len(r)]]))
        total = np.add.reduceat(spread, g) if len(g) else spread
        name = lambda s, at, salt=salt, r=r, seg=seg: t.mix(s + seg[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt[r[at]])
        keys, where, segs = [name(total, g)], [rows[r[g]]], [seg[g]]
        if deletions:
            each = np.repeat(np.arange(len(g)), size)
            many = np.flatnonzero(size[each] > 1)
            keys.append(name(total[each[many]] - spread[many], many))
            where.append(rows[r[many]])
            segs.append(seg[many])
        empty = m - np.bincount(r[g], minlength=len(rows))
        # with deletions, a segment of one shingle has no neighbourhood: it counts as empty
        lone = np.bincount(r[g][size == 1], minlength=len(rows)) if deletions else 0
        spare = (m - differ // 2 - 1 if deletions else slack) - empty - lone
        yield flag, rows, spare, np.concatenate(where), np.concatenate(segs), np.concatenate(keys)


def _deal_keys(slots: int, deletions: bool):
    def fn(batches):
        for batch in batches:
            t.release()
            ids = t.ids(batch.column("doc_id"))
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs):
                row, h = shingle_sets(batch.column("text").slice(a, b - a))
                for flag, _, _, where, seg, key in _segment_keys(row, h, b - a, deletions):
                    got = t.dealt(t.slot_of(key, slots), 0, {"key": key, "doc": ids[a:b][where], "place": 2 * seg + flag}).drop(["src"])
                    yield from got.to_batches()

    return fn


def _spare(deletions: bool):
    """(doc, flag, spare): how many crowded segments a set can have and still be covered."""

    def fn(batches):
        for batch in batches:
            t.release()
            ids = t.ids(batch.column("doc_id"))
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs):
                row, h = shingle_sets(batch.column("text").slice(a, b - a))
                for flag, rows, spare, *_ in _segment_keys(row, h, b - a, deletions):
                    yield pa.record_batch({"doc": pa.array(ids[a:b][rows]), "flag": pa.array(np.full(len(rows), flag, np.int64)), "spare": pa.array(spare.astype(np.int64))})

    return fn


def _groups(crowd: int):
    """Of one key slot: distinct groups of classes with one key (their least first), and the crowded segments."""

    def fn(table):
        t.release()
        key, doc, place = t.longs(table["key"]), t.longs(table["doc"]).view(np.int64), t.longs(table["place"]).view(np.int64)
        order = np.lexsort((doc, key))
        key, doc, place = key[order], doc[order], place[order]
        g = t.group_starts(key, doc)
        key, doc, place = key[g], doc[g], place[g]
        g = t.group_starts(key)
        size = np.diff(np.concatenate([g, [len(key)]]))
        lists: set[tuple[int, ...]] = set()
        stars: set[tuple[int, ...]] = set()
        for a, n in zip(g[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            members = doc[a : a + n].tolist()
            if n <= crowd:
                lists.add(tuple(members))
            else:
                stars.update((members[0], *members[i : i + crowd - 1]) for i in range(1, n, crowd - 1))
        bad = np.repeat(size > crowd, size)
        none = np.zeros(len(lists) + len(stars), np.int64)
        nb = int(bad.sum())
        return pa.table({
            "docs": pa.array([*sorted(lists), *sorted(stars), *[None] * nb], pa.list_(pa.int64())),
            "whole": pa.array(np.arange(len(none) + nb) < len(lists)),
            "doc": pa.array(np.concatenate([none, doc[bad]])),
            "place": pa.array(np.concatenate([none, place[bad]])),
        })

    return fn


def _key_groups(kept: DataFrame, slots: int, crowd: int, deletions: bool) -> DataFrame:
    dealt = kept.select("doc_id", "text").mapInArrow(_deal_keys(slots, deletions), "slot int, key array<bigint>, doc array<bigint>, place array<bigint>")
    return written(dealt.groupBy("slot").applyInArrow(_groups(crowd), "docs array<bigint>, whole boolean, doc long, place long").distinct(), "jaccard-groups", free=True)


def _uncovered(kept: DataFrame, groups: DataFrame, deletions: bool) -> DataFrame:
    """doc_id of the sets whose keys alone can miss a partner."""
    spare = kept.select("doc_id", "text").mapInArrow(_spare(deletions), "doc long, flag long, spare long")
    bad = groups.where("docs is null").groupBy("doc", (F.col("place") % 2).alias("flag")).agg(F.countDistinct("place").alias("bad"))
    return spare.join(bad, ["doc", "flag"], "left").where(F.coalesce("bad", F.lit(0)) > F.col("spare")).select(F.col("doc").alias("doc_id")).distinct()


def _verify(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The pairs (a, b) that link, by their whole sets."""

    def fn(batches):
        for batch in batches:
            t.release()
            _, x = t.text_bytes(batch.column("ta"))
            _, y = t.text_bytes(batch.column("tb"))
            for i, j in t.pieces(x + y):
                ra, ha = shingle_sets(batch.column("ta").slice(i, j - i))
                rb, hb = shingle_sets(batch.column("tb").slice(i, j - i))
                na, nb = np.bincount(ra, minlength=j - i), np.bincount(rb, minlength=j - i)
                r, h = np.concatenate([ra, rb]), np.concatenate([ha, hb])
                order = np.lexsort((h, r))
                r, h = r[order], h[order]
                both = np.bincount(r[1:][(r[1:] == r[:-1]) & (h[1:] == h[:-1])], minlength=j - i)
                ok = pa.array(100 * both >= 75 * (na + nb - both))
                yield pa.record_batch([batch.column(c).slice(i, j - i).filter(ok) for c in ("a", "b")], ["a", "b"])

    side = lambda x: kept.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    # sizes and sketches first: the texts of hopeless pairs are not moved
    apart = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    near = pairs.join(side("a"), "a").join(side("b"), "b").where("100 * least(na, nb) >= 75 * greatest(na, nb)").where(7 * apart("sa", "sb") <= F.col("na") + F.col("nb"))
    near = written(near.select("a", "b", "na", "nb"), "jaccard-near", free=True)
    long = (F.col("na") > LONG) & (F.col("nb") > LONG)
    wide = lambda x: kept.where(F.col("n") > LONG).select(F.col("doc_id").alias(x), F.col("wide").alias(f"w{x}"))
    far = near.where(long).join(wide("a"), "a").join(wide("b"), "b").where(7 * apart("wa", "wb") <= F.col("na") + F.col("nb"))
    likely = near.where(~long).select("a", "b").unionAll(far.select("a", "b"))
    texts = likely.join(kept.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(kept.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    links = written(texts.select("a", "b", "ta", "tb").mapInArrow(fn, "a long, b long"), "jaccard-links", free=True)
    remove(near)
    return links


def _possible(batches):
    """Pairs of each group whose labels differ and whose sizes and sketches allow a link; once per task, as groups overlap."""
    seen: list[np.ndarray] = []

    def told():
        pairs = np.unique(np.concatenate(seen), axis=0) if seen else np.zeros((0, 2), np.int64)
        seen.clear()
        return pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    for batch in batches:
        m = batch.column("m")
        size = t.lengths(m)
        x = m.flatten()
        doc, label, n = (x.field(k).to_numpy() for k in ("doc", "label", "n"))
        sketch = x.field("sketch").flatten().to_numpy().reshape(-1, SKETCH // 64)
        after = np.repeat(np.cumsum(size), size) - np.arange(len(doc)) - 1
        for a in range(0, len(doc), 512):
            count = after[a : a + 512]
            i = np.repeat(np.arange(a, a + len(count)), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            ok = (label[i] != label[j]) & (4 * np.minimum(n[i], n[j]) >= 3 * np.maximum(n[i], n[j]))
            i, j = i[ok], j[ok]
            apart = np.zeros(len(i), np.int64)
            for c in range(0, len(i), 1 << 16):
                apart[c : c + (1 << 16)] = np.bitwise_count(sketch[i[c : c + (1 << 16)]] ^ sketch[j[c : c + (1 << 16)]]).sum(1, dtype=np.int64)
            ok = 7 * apart <= n[i] + n[j]
            i, j = i[ok], j[ok]
            seen.append(np.unique(np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])], 1), axis=0))
            if sum(map(len, seen)) > 1 << 20:
                yield told()
    yield told()


def _pairs(groups: DataFrame, kept: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different labels within the whole groups that may link."""
    member = groups.where("whole").select(F.xxhash64("docs").alias("g"), F.col("docs")[0].alias("g0"), F.explode("docs").alias("doc"))
    member = member.join(labels, member.doc == labels.node, "left").select("g", "g0", "doc", F.coalesce("label", "doc").alias("label"))
    mixed = member.groupBy("g", "g0").agg(F.collect_list(F.struct("doc", "label")).alias("m"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    info = kept.select(F.col("doc_id").alias("doc"), "n", "sketch")
    told = mixed.select("g", "g0", F.explode("m").alias("x")).select("g", "g0", "x.doc", "x.label").join(info, "doc")
    return told.groupBy("g", "g0").agg(F.collect_list(F.struct("doc", "label", "n", "sketch")).alias("m")).select("m").mapInArrow(_possible, "a long, b long").distinct()


def _rarest(kept: DataFrame) -> DataFrame:
    """(h, doc, n): each set's rarest shingles, as many as a linked pair must share one of, without those nobody shares."""

    def fn(batches):
        for batch in batches:
            ids = t.ids(batch.column("doc_id"))
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs):
                row, h = shingle_sets(batch.column("text").slice(a, b - a))
                n = np.bincount(row, minlength=b - a)
                yield pa.record_batch({"doc": pa.array(ids[a:b][row]), "n": pa.array(n[row].astype(np.int64)), "h": pa.array(h.view(np.int64))})

    rows = kept.select("doc_id", "text").mapInArrow(fn, "doc long, n long, h long")
    often = rows.groupBy("h").agg(F.count("*").alias("c"))
    by_rarity = Window.partitionBy("doc").orderBy("c", "h")
    prefix = rows.join(often, "h").withColumn("k", F.row_number().over(by_rarity)).where("k <= n - (3 * n + 3) div 4 + 1 and c > 1")
    return written(prefix.select("h", "doc", "n"), "jaccard-rarest", free=True)


def _labelled(prefix: DataFrame, labels: DataFrame) -> DataFrame:
    return prefix.join(labels, prefix.doc == labels.node, "left").select("h", "doc", "n", F.coalesce("label", "doc").alias("label"))


def _pivots(prefix: DataFrame, labels: DataFrame, seeds: list[int]) -> DataFrame:
    """Pairs of each set with a few sets, chosen by hash, that share one of its rarest shingles and have another label."""
    rows = _labelled(prefix, labels)
    chosen = [F.min_by(F.struct("doc", "n", "label"), F.xxhash64("doc", F.lit(seed))) for seed in seeds]
    pivots = rows.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.array_distinct(F.array(*chosen)).alias("p"))
    pivots = pivots.where("low < high").select("h", F.explode("p").alias("p"))
    found = rows.join(pivots, "h").where("label <> p.label and 4 * least(n, p.n) >= 3 * greatest(n, p.n)")
    return found.select(F.least("doc", "p.doc").alias("a"), F.greatest("doc", "p.doc").alias("b")).distinct()


def _rest_pairs(prefix: DataFrame, kept: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different labels that share one of their rarest shingles and may link.

    The sets of a shingle are dealt into parts of at most ``PART`` sets, and
    every two parts meet in one list, so a list is of bounded size; the pairs are
    made and tested by sketch inside the tasks.
    """
    rows = _labelled(prefix, labels)
    often = rows.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = rows.join(often.where("low < high").select("h", "parts"), "h")
    mine = F.pmod(F.xxhash64("doc"), "parts").cast("int")
    dealt = rows.withColumn("mine", mine).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("h", F.least("mine", "k").alias("i"), F.greatest("mine", "k").alias("j"), "doc", "label")
    told = dealt.join(kept.select(F.col("doc_id").alias("doc"), "n", "sketch"), "doc")
    lists = told.groupBy("h", "i", "j").agg(F.collect_list(F.struct("doc", "label", "n", "sketch")).alias("m"))
    return lists.where("size(m) > 1").select("m").mapInArrow(_possible, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, crowd: int = CROWD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    blocks, n_blocks, slots = in_blocks(docs, block_bytes)
    sized = written(_sizes(docs), "jaccard-sizes")
    classes = sized.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int").alias("slot")
    reps = classes.select(F.col("rep").alias("doc_id")).distinct().select(block, F.array("doc_id").alias("hash"))
    asked = blocks.groupBy("block").cogroup(reps.groupBy("slot")).applyInArrow(_ask(slots), ASKED)
    again = asked.groupBy("slot").applyInArrow(recurring, TOLD)
    told = reps.select("slot", F.lit(0).alias("kind"), "hash").unionAll(again.select("slot", F.lit(1), "hash"))
    kept = written(blocks.groupBy("block").cogroup(told.groupBy("slot")).applyInArrow(_keep, "doc_id long, n long, sketch array<bigint>, wide array<bigint>, text string"), "jaccard-kept", "zstd", free=True)

    groups = _key_groups(kept, slots, crowd, False)
    listed = groups.where("docs is not null")
    star = listed.select(F.col("docs")[0].alias("a"), F.explode("docs").alias("b")).where("a < b").distinct()
    links = _verify(star, kept)
    labels = components(links)

    # what the least member of a group does not connect
    left = written(_uncovered(kept, groups, False), "jaccard-uncovered", free=True)
    wider, prefix, used = [], None, [groups, left]
    if not left.isEmpty():
        rest = written(kept.join(left, "doc_id", "left_semi"), "jaccard-rest", "zstd", free=True)
        near = _key_groups(rest, slots, crowd, True)
        wider = [near.where("docs is not null")]
        last = written(_uncovered(rest, near, True), "jaccard-last", free=True)
        used += [near, rest, last]
        if not last.isEmpty():
            prefix = _rarest(rest.join(last, "doc_id", "left_semi"))
            used.append(prefix)
            # crowds of near copies: a few comparisons a set connect nearly all of them
            for turn in range(TURNS):
                found = _verify(_pivots(prefix, labels, [PIVOTS * turn + i for i in range(PIVOTS)]), kept)
                if found.isEmpty():
                    break
                links = links.unionAll(found)
                labels = components(links)
    more = reduce(DataFrame.unionAll, [_pairs(g, kept, labels) for g in (listed, *wider)])
    if prefix is not None:
        more = more.unionAll(_rest_pairs(prefix, kept, labels))
    more = written(more.distinct().join(star, ["a", "b"], "left_anti"), "jaccard-more", free=True)
    for table in used:
        remove(table)
    if not more.isEmpty():
        labels = components(links.unionAll(_verify(more, kept)))
    remove(kept)

    member = sized.join(classes, ["n_shingles", "f1", "f2"], "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    return member.join(labels, member.rep == labels.node, "left").select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component only the document with the smallest doc_id stays."""
    first = jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").select(*docs.columns)
