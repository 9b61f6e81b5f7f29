from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from brute import jaccard_components, repeated, words
from pyspark.sql import functions as F

from eventlake.llm import op1_substring_dedup as op1
from eventlake.llm import op4_jaccard_join as op4
from eventlake.llm import op9_suffix_dedup as op9
from eventlake.llm import textops as t
from eventlake.llm.components import components
from eventlake.session import checkpoint_dir


@pytest.mark.parametrize("block_bytes", [1 << 21, 40_000])
def test_substring_dedup(docs, raw_docs, block_bytes):
    rows = [r for r in raw_docs if r[0] is not None]
    units = [words(x) for _, x in rows]
    want = sorted(
        (d, len(u), sum(go), " ".join(w for w, g in zip(u, go, strict=True) if not g))
        for (d, _), u, go in zip(rows, units, repeated(rows, units, 13), strict=True)
    )
    assert sorted(map(tuple, op1.substring_dedup(docs, block_bytes=block_bytes).collect())) == want


@pytest.mark.parametrize(("block_bytes", "hot"), [(1 << 20, 64), (30_000, 1)])
def test_suffix_dedup(docs, raw_docs, block_bytes, hot):
    rows = [r for r in raw_docs if r[0] is not None]
    units = [(x or "").encode() for _, x in rows]
    want = []
    for (d, _), u, go in zip(rows, units, repeated(rows, units, 50), strict=True):
        kept = bytes(b for b, g in zip(u, go, strict=True) if not g)
        spans = len(re.findall("1+", "".join("1" if g else "0" for g in go)))
        want.append((d, len(u), sum(go), spans, hashlib.sha256(kept).hexdigest()))
    got = op9.suffix_dedup(docs, hot=hot, block_bytes=block_bytes).withColumn("kept", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("crowd", [32, 2])
def test_jaccard_components(docs, raw_docs, crowd):
    want = jaccard_components([r for r in raw_docs if r[0] is not None])
    got = op4.jaccard_components(docs, crowd=crowd, block_bytes=200_000).collect()
    assert len(got) == len([r for r in raw_docs if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_jaccard_many_near_copies(spark):
    """Chains and crowds around the threshold, in groups larger than the crowd."""
    rng = random.Random(4)
    rows, base = [], [f"w{i}" for i in range(40)]
    for d in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(40)] = f"n{rng.randrange(6)}"
        rows.append((d, " ".join(w)))
    for d in range(120, 160):  # a common passage in different texts
        rows.append((d, " ".join(base[:15] + [f"u{d}_{i}" for i in range(rng.randint(5, 60))])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = jaccard_components(rows)
    for crowd in (4, 16):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in op4.jaccard_components(table, crowd=crowd).collect()} == want


@pytest.mark.parametrize("hot", [64, 1])
def test_suffix_dedup_with_ids_of_any_size(spark, raw_docs, hot):
    """Ids that need more than 32 bits, and negative ones, keep their order."""
    rows = [(d * (1 << 44) - (1 << 50), x) for d, x in raw_docs if d is not None]
    units = [(x or "").encode() for _, x in rows]
    want = sorted((d, sum(go)) for (d, _), go in zip(rows, repeated(rows, units, 50), strict=True))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = op9.suffix_dedup(table, hot=hot, block_bytes=30_000).select("doc_id", "n_removed")
    assert sorted(map(tuple, got.collect())) == want


def test_empty_tables(no_docs):
    assert op1.substring_dedup(no_docs).count() == 0
    assert op9.suffix_dedup(no_docs).count() == 0
    assert op4.jaccard_components(no_docs).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (5, 6), (9, 9), (8, 7), (7, 3)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 7, 8), 1), **dict.fromkeys((4, 5, 6), 4), **dict.fromkeys(range(100, 131), 100)}


def test_suffix_dedup_splits_only_the_hot_trigger_itself():
    """A trigger with the 32 bits of a hot one, but of another slot, stays whole."""
    import numpy as np
    import pyarrow as pa

    from eventlake.llm import textops as t

    text = " ".join(f"some{i} words{i * i}" for i in range(20))
    p = op9.Phrases(pa.table({"doc_id": [1, 2], "text": [text, text]}), op9.WIDTH, op9.RUN)
    k = int(np.argmax(p.last - p.first))
    slots, trigger = 7, p.trigger[k]
    other = next(x for x in trigger + (np.arange(1, 99, dtype=np.uint64) << np.uint64(40)) if t.slot_of(x, slots) != t.slot_of(trigger, slots))
    told = []
    for h in (trigger, other):
        h = np.array([h, h], np.uint64)
        slot = int(t.slot_of(h, slots)[0])
        sent = pa.concat_tables([op9._number(t.dealt(np.zeros(1, np.int64), src, {"hash": op9._short(h[:1]), "multi": np.ones(1, np.int8)}), "multi") for src in (0, 1)])
        told.append(op9._answer(1 if h[0] == other else 9)((pa.scalar(slot),), sent))
    _, _, _, first, last, _ = p.recurring(*op9._hot_of(pa.concat_tables(told)), slots)
    assert p.last[k] > p.first[k] and last[first == p.first[k]].tolist() == [p.last[k]]


def test_hashing_spans_holds_no_copies_of_the_whole_block():
    buf = np.random.default_rng(3).integers(97, 123, 8 << 20, dtype=np.uint8)
    buf[::7] = 32
    starts, ends, _ = t.words(buf, np.array([0, len(buf)]))
    t.span_hash(buf[:100], starts[:10], ends[:10])
    tracemalloc.start()
    got = t.span_hash(buf, starts, ends)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(starts) + (24 << 20)
    at = [0, 1, t._SPANS - 1, t._SPANS, len(starts) - 1]
    alone = [t.span_hash(buf[a:b], np.array([0]), np.array([b - a]))[0] for a, b in zip(starts[at], ends[at], strict=True)]
    assert got[at].tolist() == [int(x) for x in alone]


def test_wide_sketches_tell_long_sets_apart():
    rng = random.Random(5)
    pick = lambda n: [rng.getrandbits(64) for _ in range(n)]
    a, b, near = pick(5000), pick(5000), pick(100)
    sets = [sorted(a), sorted(b), sorted(a[:-100] + near), sorted(pick(10))]
    row, h = np.repeat(np.arange(4), [len(x) for x in sets]), np.array([v for x in sets for v in x], np.uint64)
    wide = op4.wide_sketches(row, h, 4).to_pylist()
    apart = lambda x, y: sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x, y, strict=True))
    assert wide[3] == []
    assert apart(wide[0], wide[2]) <= 200
    assert 7 * apart(wide[0], wide[1]) > 10000
    narrow = op4.sketches(row, h, 4).tolist()
    assert 7 * apart(narrow[0], narrow[1]) <= 10000  # the narrow one can't tell


def test_jaccard_links_of_long_texts(spark):
    rng = random.Random(8)
    text = [f"{rng.getrandbits(40):x}" for _ in range(2500)]
    near, limit = list(text), list(text)
    for i in rng.sample(range(2500), 30):
        near[i] = "n"
    for i in rng.sample(range(2500), 110):
        limit[i] = f"l{i}"
    rows = [(i, " ".join(x)) for i, x in enumerate([text, near, limit, text[:1200], text[:1150], [w + "x" for w in text]])]
    got = {r.doc_id: r.component_id for r in op4.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: component for i, (_, component) in jaccard_components(rows).items()}


def test_jaccard_frees_its_tables(spark):
    root = Path(checkpoint_dir(spark).removeprefix("file://"), "eventlake-scratch")
    before = set(root.glob("*"))
    base = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join([*base[:39], f"w{i}"])) for i in range(50)], "doc_id long, text string")
    assert op4.jaccard_components(docs).where("component_id = 0").count() == 50
    assert not {p.name.rsplit("-", 1)[0] for p in set(root.glob("*")) - before} & {"jaccard-kept", "jaccard-groups", "jaccard-near", "jaccard-uncovered"}
