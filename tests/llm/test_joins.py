from __future__ import annotations

import collections
import random

import numpy as np
import pytest
from brute import SF_SMALL, low, words

from eventlake.llm import op7_embedding_join as op7
from eventlake.llm import op10_decontaminate as op10


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    out = []
    for _ in range(25):
        centre = rng.normal(size=16)
        out += [(centre + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3])).astype(np.float32) for _ in range(rng.integers(1, 12))]
    rows = [(i, x.tolist()) for i, x in enumerate(out)]
    rows += [(5000 + i, out[0].tolist()) for i in range(30)]
    return rows + [(6000, None), (6001, [0.0] * 16), (6002, [float("nan")] * 16), (6003, [1.0] * 15 + [None]), (6004, []), (6005, [float("inf")] + [1.0] * 15), (3, rows[3][1]), (None, rows[3][1])]


@pytest.mark.parametrize(("part", "guests"), [(8192, 16384), (20, 30)])
def test_vectors(spark, vectors, part, guests):
    rows = spark.createDataFrame([(i, e, 1, 2) for i, e in vectors], "vec_id long, embedding array<float>, cell int, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op7.near_vectors(rows, part=part, guests=guests).collect()}
    sound = dict((i, np.array(e, np.float32).astype(float)) for i, e in vectors if i is not None and e and None not in e and np.isfinite(e).all() and any(e))
    ids = sorted(sound)
    m = np.stack([sound[i] for i in ids])
    norm = np.linalg.norm(m, axis=1)
    near = (m @ m.T) / np.outer(norm, norm) >= 0.95
    np.fill_diagonal(near, False)
    label = np.array(ids)
    for _ in ids:
        label = np.array([min([label[k], *label[near[k]]]) for k in range(len(ids))])
    for k, i in enumerate(ids):
        assert got[i] == (near[k].sum(), label[k], label[k] == i)
    for i in range(6000, 6006):
        assert got[i] == (0, i, True)
    assert None not in got


def test_vectors_of_extreme_length(spark):
    """Lengths whose squares overflow or vanish in double precision, and subnormal components."""
    rows = [(1, [1e200, 1e200]), (2, [2e200, 2e200]), (3, [1e-200, 1e-200]), (4, [1.0, 1.0]), (5, [1.7e308, 1.7e308]), (6, [5e-324, 5e-324]), (7, [1e300, -1e300]), (8, [1e-310, -1e-310]), (9, [1e200, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in op7.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {**{i: (5, 1) for i in range(1, 7)}, 7: (1, 7), 8: (1, 7), 9: (0, 9)}


def test_no_vectors(spark):
    assert op7.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, op7.near_vectors(only).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def bag(w):
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def test_decontamination(spark, raw_docs):
    rng = random.Random(3)
    docs = [(d, x) for d, x in raw_docs if d is not None]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    plain = [x.split()[:30] for _, x in docs if x and len(x.split()) > 30]
    for k, (_, x) in enumerate(items):
        for edits in range(5):
            w = x.split()
            for _ in range(edits):
                i, how = rng.randrange(len(w)), rng.random()
                if how < 0.4:
                    w[i] = f"zz{rng.randrange(99)}"
                elif how < 0.7:
                    w.insert(i, "yy")
                elif len(w) > 3:
                    del w[i]
            around = rng.choice(plain)
            docs.append((200_000 + 10 * k + edits, " ".join(around + (w if edits % 2 else [v.upper() for v in w]) + around[::-1])))
    items += [(9001, None), (9002, ""), (9003, "lone"), (9004, "a b " * 7), (None, "lone"), (9005, items[0][1])]
    docs += [(300_001, "x " + "a b " * 7 + "y"), (300_002, "lone")]
    found = op10.contaminated(spark.createDataFrame([(d, x, 1) for d, x in docs], "doc_id long, text string, pos int").repartition(4), spark.createDataFrame([(k, x, 1) for k, x in items], "item_id long, text string, m int"))
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 9)) for r in found.collect()}
    split = [(k, words(low(x))) for k, x in items if k is not None and words(x)]
    holds = collections.defaultdict(set)
    for k, w in split:
        for g in bag(w):
            holds[g].add(k)
    want = {}
    texts = dict(split)
    for d, x in docs:
        w = words(low(x))
        near = set().union(*[holds.get(tuple(w[i : i + n]), set()) for n in range(1, 6) for i in range(len(w) - n + 1)]) if w else set()
        for k in near:
            item, m = bag(texts[k]), len(texts[k])
            for s in range(max(1, len(w) - m + 1)):
                mine = bag(w[s : s + m])
                same = sum((mine & item).values())
                sim = same / (sum(mine.values()) + sum(item.values()) - same)
                if sim >= 0.75 and sim > want.get((d, k), (0, 0, 0))[2]:
                    want[d, k] = (s, m, sim)
    assert got == {k: (s, m, round(x, 9)) for k, (s, m, x) in want.items()}
    assert len(want) > 50


def test_decontamination_of_nothing(spark, docs, no_docs):
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert op10.contaminated(no_docs, benchmark).count() == 0
    assert op10.contaminated(docs, benchmark.limit(0)).count() == 0


def window_matches(docs, items):
    """(doc_id, item_id): start, size and similarity of the best window, by trying all."""
    want = {}
    for d, x in docs:
        w = words(low(x))
        for k, y in items:
            y = words(low(y))
            item, m = bag(y), len(y)
            for s in range(max(1, len(w) - m + 1)):
                mine = bag(w[s : s + m])
                same = sum((mine & item).values())
                sim = same / (sum(mine.values()) + sum(item.values()) - same)
                if sim >= 0.75 and sim > want.get((d, k), (0, 0, 0))[2]:
                    want[d, k] = (s, m, sim)
    return {k: (s, m, round(x, 9)) for k, (s, m, x) in want.items()}


def check_windows(spark, docs, items):
    found = op10.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = window_matches(docs, items)
    assert {(r.doc_id, r.item_id): (r.start, r.n_words, round(r.similarity, 9)) for r in found} == want
    return want


def test_decontamination_of_reordered_items(spark):
    rng = random.Random(7)
    items = [(k, " ".join(f"{'abcdefgh'[rng.randrange(8)] * rng.randint(1, 9)}{k}x{i}" for i in range(40 + 5 * k))) for k in range(6)]
    around = [f"filler{i}" for i in range(60)]
    docs = []
    for k, x in items:
        w = x.split()
        for j, at in enumerate((8, len(w) // 2, len(w) - 12)):
            docs.append((10 * k + j, " ".join(around + w[at:] + w[:at] + around)))
    assert len(check_windows(spark, docs, items)) == len(docs)


def test_decontamination_of_texts_shorter_than_the_item(spark):
    items = [(k, " ".join([f"w{k}x{i}" for i in range(m - m // 5)] + [f"longest{k}x{i}" for i in range(m // 5)])) for k, m in enumerate((20, 22, 24, 40))]
    docs = [(k, " ".join(x.split()[: len(x.split()) - len(x.split()) // 5])) for k, x in items]
    assert len(check_windows(spark, docs, items)) == len(docs)


def test_decontamination_of_long_items(spark):
    """Items of thousands of words: once as they are, once with every fortieth word changed."""
    rng = random.Random(11)
    long = [f"{'abcdef'[rng.randrange(6)] * rng.randint(1, 6)}{rng.randrange(900)}" for _ in range(4000)]
    changed = [f"zz{i}" if i % 40 == 7 else w for i, w in enumerate(long)]
    around = [f"filler{i}" for i in range(500)]
    docs = [(1, " ".join(around + long + around)), (2, " ".join(around[:90] + changed)), (3, " ".join(long[:1500] + around + long[1500:2000]))]
    found = op10.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(5, " ".join(long))], "item_id long, text string"))
    got = {(r.doc_id, r.item_id): (r.start, r.n_words, r.similarity) for r in found.collect()}
    item = bag(long)
    same = sum((bag(changed) & item).values())
    assert set(got) == {(1, 5), (2, 5)}
    assert got[1, 5] == (500, 4000, 1.0)
    assert got[2, 5][:2] == (90, 4000) and abs(got[2, 5][2] - same / (2 * sum(item.values()) - same)) < 1e-9
