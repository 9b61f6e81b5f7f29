"""Operator 12 against numpy on integer vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from brute import SF_SMALL

from eventlake.llm import op12_whitening as op12

KIND = "vec_id long, embedding array<double>, label int, x string, row long, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], KIND)


def brute(rows, k=16):
    """Per usable row: id, deviation, |whitened| per component; explained; all by numpy on the distinct vectors."""
    good = [(i, v) for i, v in rows if v is not None and not any(c is None or not math.isfinite(c) for c in v)]
    dim = max((len(v) for _, v in good), default=0)
    x = [tuple(math.floor(64 * c) + 1000000 for c in (*v, *[0.0] * (dim - len(v)))) for _, v in good]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(col) for col in zip(*fit, strict=True)]
    centre = lambda v: np.array([(n * a - s) / n for a, s in zip(v, sums, strict=True)])
    c = np.array([centre(v) for v in fit])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][: min(k, dim)], u[:, ::-1][:, : min(k, dim)]
    out = []
    for (i, _), v in zip(good, x, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        out.append((i, deviation, np.abs(centre(v) @ u) / np.sqrt(np.maximum(e, 1e-9))))
    return n, out, e / np.trace(c.T @ c / n) if len(fit) > 1 else e


def same(got, rows, k=16):
    n, want, share = brute(rows, k)
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted([(r.vec_id, r.deviation, r.whitened) for r in got], key=key), sorted(want, key=key), strict=True):
        assert g[:2] == w[:2]
        np.testing.assert_allclose(np.abs(g[2]), w[2], rtol=1e-6, atol=1e-6)
    assert {r.n for r in got} == {n}
    assert all(r.identity_error < 1e-6 for r in got)
    np.testing.assert_allclose(got[0].explained, share, rtol=1e-9)


def special(dim=6, n=300, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dim) * (1 + np.arange(dim))).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # a third of all rows is one vector
    rows += [(None, rows[4][1]), (7, rows[8][1]), (2000, None), (2001, [None] * dim), (2002, [1.0, math.nan] + [0.0] * (dim - 2)), (2003, [math.inf] * dim)]
    return rows + [(2004, [1.5, -2.0]), (2005, []), (2006, [1e300] * dim)]


@pytest.mark.parametrize("per_block", [1024, 16])
def test_against_numpy(spark, monkeypatch, per_block):
    monkeypatch.setattr(op12, "ROWS", per_block)
    rows = special()
    got = op12.whiten(frame(spark, rows).repartition(5)).collect()
    same(got, [r for r in rows if r[0] != 2006])


def test_more_dimensions_than_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=20) * np.linspace(1, 3, 20)).tolist()) for i in range(200)]
    got = op12.whiten(frame(spark, rows)).collect()
    assert all(len(r.whitened) == 16 for r in got)
    same(got, rows)


def test_no_variance(spark):
    got = op12.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [(i, 1, 0, [0.0, 0.0], [0.0, 0.0], 0.0) for i in (1, 2)]
    # one direction only: the other component is nothing
    got = op12.whiten(frame(spark, [(i, [float(i), 5.0]) for i in range(9)])).collect()
    assert all(r.whitened[1] == 0 and r.explained == [1.0, 0.0] and r.identity_error < 1e-9 for r in got)


def test_empty(spark):
    assert op12.whiten(frame(spark, [])).collect() == []
    assert op12.whiten(frame(spark, [(1, None), (2, [])])).collect() == []


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op12.op12_whitening(spark, SF_SMALL)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"),
    ]
    n, want, share = brute(rows)
    want = {(i, j + 1): (d, w[j], share[j]) for i, d, w in want for j in range(16)}
    done = got.collect()
    assert len(done) == len(want)
    for r in done:
        d, w, s = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, d)
        assert abs(abs(r.whitened) - w) < 1e-6 and abs(r.explained - s) < 1e-9 and r.identity_error < 1e-6
