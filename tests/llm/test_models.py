from __future__ import annotations

import collections
import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from brute import SF_SMALL, crc, low, words
from pyspark.sql import functions as F

from eventlake.llm import op2_quality as op2
from eventlake.llm import op5_language as op5
from eventlake.llm import op6_class_lm as op6

MID = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    got = op5.op5_language(spark, MID).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_special_rows(spark, no_docs):
    net = op5.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "12 !! %%", 1), (None, "the and of", 1), (4, "the and of " * 50_000, 1)], "doc_id long, text string, lang int")
    got = {r.doc_id: (r.lang_pred, r.score) for r in op5.predict(rows, net).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and got[None][0] != "und"
    assert op5.train(no_docs) is None
    assert op5.predict(no_docs, net).count() == 0
    assert {r.lang_pred for r in op5.predict(rows, None).collect()} == {"und"}


def test_language_stage_keeps_columns_and_clean_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    junk = spark.createDataFrame([(9999, "123 ### 456", None, "x", 11)], docs.schema)
    got = op5.stage(spark, docs.unionAll(junk), SF_SMALL)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in docs.collect()}


def test_quality_held_out(spark):
    got = op2.op2_quality(spark, "/root/testdata/sf0.1").join(op2.graded(spark.read.parquet("/root/testdata/sf0.1/labels.parquet")), "doc_id").where("held_out").collect()
    share = lambda g: sum(r.kept for r in got if r.grade == g) / sum(r.grade == g for r in got)
    assert share(2) >= 0.95 and share(0) <= 0.1 and share(1) <= 0.15
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_prob <= 1 for r in got)


def test_quality_special_rows(spark, docs, no_docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    odd = spark.createDataFrame([(100_001, 1, 0), (100_002, None, None), (None, 0, 1), (100_004, 0, None), (100_004, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in op2.graded(odd).collect()} == {100_001: 2, 100_004: 0}
    model = op2.train(docs, labels.unionByName(odd))
    got = op2.score(docs, model)
    assert got.count() == docs.count()
    a = [r for r in got.where("doc_id = 100010").collect()]
    assert len(a) == 2 and a[0] == a[1]
    assert op2.score(no_docs, model).count() == 0
    flat = op2.train(no_docs, labels)
    assert not flat.fitted
    assert {round(r.tail_prob, 6) for r in op2.score(docs, flat).collect()} == {round(1 / 3, 6)}


def test_ordinal_thresholds_and_gradient():
    import numpy as np

    rng = np.random.default_rng(0)
    grade = rng.integers(0, 3, 600)
    row = np.repeat(np.arange(600), 2)
    place = np.stack([grade, 10 + rng.integers(0, 3, 600)], 1).ravel()
    model = op2.CumulativeLink()
    model.fit(row, place, grade)
    assert model.cuts[0] < model.cuts[1]
    assert model.weight[0] < model.weight[1] < model.weight[2]
    assert (model.weight[10:13] == 0).all()  # no association with the grade


def test_class_lm(docs, raw_docs):
    got = collections.defaultdict(list)
    for r in op6.class_lm_scores(docs, block_bytes=50_000).collect():
        got[r.doc_id].append(r)
    rows = [(d, [*words(low(x)), None]) for d, x in raw_docs if d is not None]
    count = collections.Counter(w for d, ws in rows if crc(d) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    assert sum(map(len, got.values())) == len(rows)
    for d, ws in rows:
        r = got[d][0]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(d) % 7 == 2, len(ws), sum(count[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
        assert math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)


def test_class_lm_beats_base_and_is_a_distribution(spark):
    import numpy as np

    r = op6.op6_class_lm(spark, MID).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]
    frequent = np.sort(np.array([11, 22], np.uint64))
    n = len(frequent) + op6.BANDS * op6.KINDS + 1
    rng = np.random.default_rng(1)
    m = np.zeros((n + 1, n), np.int64)
    used = [0, 1, 2, 3, 5, n - 1]
    m[np.ix_([*used, n], used)] = rng.integers(0, 9, (len(used) + 1, len(used)))
    model = op6.ClassModel(m, frequent, int(m.sum()), 50, 4, 5, op6.BETA)
    for before in range(5):
        p = 10 ** (model.step[before, model.cls] + model.unit)
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)


def test_exchange_finds_planted_classes():
    import numpy as np

    rng = np.random.default_rng(2)
    kind = np.arange(12) // 4  # words of a kind are followed by words of the next
    m = np.array([[rng.integers(20, 80) if kind[b] == (kind[a] + 1) % 3 else rng.integers(0, 4) for b in range(12)] for a in range(12)] + [[10] * 4 + [0] * 8])
    cls = op6.exchange(m, 3, 10)
    assert [len(set(cls[kind == k].tolist())) for k in range(3)] == [1, 1, 1] and len(set(cls.tolist())) == 3


def test_class_lm_without_training_tokens(spark, no_docs):
    held = next(i for i in range(100) if crc(i) % 7 == 2)
    r = op6.class_lm_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)
    assert op6.class_lm_scores(no_docs).count() == 0


def test_class_lm_moves_one_unit_by_its_exact_gain():
    import numpy as np

    rng = np.random.default_rng(5)
    n, classes = 12, 4
    m = rng.poisson(2.0, (n + 1, n)).astype(float)  # with repeats (own) and starts
    cls = rng.integers(0, classes, n)

    def table(c):
        member = np.eye(classes)[c]
        return np.concatenate([member.T @ m[:n] @ member, (m[n] @ member)[None]])

    member = np.eye(classes)[cls]
    own = np.diag(m[:n])
    to, frm = m[:n] @ member, m[:n].T @ member
    to[np.arange(n), cls] -= own
    frm[np.arange(n), cls] -= own
    new = op6.moved(to, frm, own, m[n], cls, table(cls))
    assert (new != cls).any()
    for w in range(n):
        value = [op6.mutual(table(np.where(np.arange(n) == w, c, cls))) for c in range(classes)]
        assert math.isclose(value[new[w]], max(value), rel_tol=1e-12)


def test_class_lm_counts_as_digits():
    n = np.array([0, 1, 255, 256, 300, 65_535, 1 << 16, (1 << 24) + 5, (1 << 31) - 1])
    place, digit, value = op6._digits(n)
    assert value.min() > 0 and value.max() <= 255 and digit.max() < op6.DIGITS
    assert np.bincount(place, value << 8 * digit, len(n)).astype(int).tolist() == n.tolist()


def test_class_lm_does_not_depend_on_blocks(docs):
    """Words, classes and scores are of the corpus, however it is dealt to blocks."""
    one, many = ({r.doc_id: r for r in op6.class_lm_scores(docs, share=0.01, classes=300, block_bytes=b).collect()} for b in (1 << 21, 20_000))
    assert one.keys() == many.keys()
    for d, r in one.items():
        assert (r.n_known, r.train_tokens, r.base_score) == pytest.approx((many[d].n_known, many[d].train_tokens, many[d].base_score))
        assert r.score == pytest.approx(many[d].score)


def test_class_lm_learns_the_neighbours_of_rarer_words(spark):
    """Nouns and verbs of one count band, one ending and a share far below ``share``."""
    import random

    rng = random.Random(1)
    train = [i for i in range(2000) if crc(i) % 7 != 2][:300]
    a, b = [i for i in range(2000, 3000) if crc(i) % 7 == 2][:2]
    text = lambda first, second: " ".join(f"the {first}{rng.randrange(100)} will {second}{rng.randrange(100)}" for _ in range(10))
    rows = [(d, text("n", "v")) for d in train] + [(a, text("n", "v")), (b, text("v", "n"))]
    got = {r.doc_id: r for r in op6.class_lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), share=0.05, classes=8, block_bytes=20_000).collect()}
    assert got[a].n_known == got[b].n_known == 41
    assert got[a].score > got[b].score + 5


def test_class_lm_is_a_distribution(spark):
    """Every word after a text's start, and one never seen of each kind, sum to one."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    vocabulary = sorted({w for r in docs.collect() if crc(r.doc_id) % 7 != 2 for w in words(low(r.text))})
    out = [i for i in range(10**6, 10**6 + 8 * len(vocabulary) + 200) if crc(i) % 7 == 2]
    probes = [*vocabulary, "qqzzx", "qqzzx.", "qqzzx7", ""]
    table = docs.unionAll(spark.createDataFrame(list(zip(out, probes, strict=False)), docs.schema))
    got = {r.doc_id: r.score for r in op6.class_lm_scores(table).where("held_out").collect()}
    pairs = {w: got[d] for d, w in zip(out, probes, strict=False)}
    # a text's score is of its word after the start and of the end after it; words of a class share the end's part
    assert len(pairs) == len(probes) and all(math.isfinite(x) and x < 0 for x in pairs.values())
    assert sum(10**x for x in pairs.values()) <= 1 + 1e-9


def test_class_lm_weighs_only_the_units_of_the_turn(monkeypatch):
    classes, n = 4, 1000
    kinds = 2 * classes + 2
    units = np.sort(op6.t.mix(np.arange(n, dtype=np.uint64)))
    block = pa.table({
        "slot": pa.array([0], pa.int32()), "src": pa.array([0], pa.int32()), "hash": op6._blobs(units, [0, n]),
        "cls": op6._blobs((np.arange(n) % classes).astype(np.uint8), [0, n]), "size": op6._blobs(np.ones(n, np.uint32), [0, n]),
        "code": op6._blobs((np.arange(n) % kinds).astype(np.uint8), [0, n]), "n": op6._blobs(np.full(n, 3, np.uint8), [0, n]),
    })
    sums = op6._sum_contexts(classes)((pa.scalar(0),), block)
    g = np.array(sums["g"][0].as_py(), float).reshape(classes + 1, classes)
    weighed, real = [], op6.moved
    monkeypatch.setattr(op6, "moved", lambda to, *rest: weighed.append(len(to)) or real(to, *rest))
    old = np.arange(n) % classes
    for turn in range(op6.PARTS):
        chosen = next(op6._choose(SimpleNamespace(value=g), classes, turn)(iter(sums.to_batches())))
        new = op6._values(chosen.column("cls"), np.uint8)
        mine = (op6.t.mix(units) >> np.uint64(40)) % np.uint64(op6.PARTS) == turn
        assert (new[~mine] == old[~mine]).all()
    assert sum(weighed) == n
