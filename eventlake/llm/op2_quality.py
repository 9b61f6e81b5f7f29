"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A rating has three ordered grades: 0 toxic, 1 poor (quality 0), 2 good. One
weight vector over hashed text features gives a document's score f; thresholds
a < b are shared by all: P(grade <= k) = 1 / (1 + exp(f - threshold_k)). From
these come the expected grade and the tail probability P(grade >= 2) that
selection uses. Features are the distinct words of the whole text (lower case,
outer punctuation off) and, in powers of two, the shares of its words with a
given ending or in capitals and of its repeated words, hashed to 2**18 places.

Training is numpy on a bounded sample: at most ``sample`` rated documents in
hash order. A document is kept if its tail probability is at least ``least`` and
grade 0 is not its likeliest. Null and empty texts have no features: they get
the score 0 of an empty text. Ratings that are null or disagree on a doc_id use
the worst known grade; repeated rows are scored one by one; without ratings of
two grades every grade is equally likely.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t

PLACES = 1 << 18
#: bound of the training sample
SAMPLE = 8000
GRADES = 3
LEAST = 0.5
#: least chi-square of a feature that the model uses: far above what chance gives any of the places
TOLD = 30.0
OFTEN = 8
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every row's distinct features."""
    buf, offs = t.text_bytes(column)
    starts, ends, row = t.words(buf, offs)
    n_rows = len(offs) - 1
    if len(starts) == 0:
        z = np.zeros(0, np.int64)
        return z, z
    low = t.lower_ascii(buf)
    letter = _LETTER[buf]
    at = np.arange(len(buf))
    following = np.minimum.accumulate(np.where(letter, at, len(buf))[::-1])[::-1]
    preceding = np.maximum.accumulate(np.where(letter, at, -1))
    a, b = following[starts], preceding[ends - 1] + 1
    plain = b > a
    a, b = np.where(plain & (a < ends), a, starts), np.where(plain & (b > starts), b, ends)
    word = t.span_hash(low, a, b)
    n_words = np.bincount(row, minlength=n_rows)
    # shares: endings, capitals, repeats
    tail = t.span_hash(low, np.minimum(b, ends), ends)
    second = np.minimum(a + 1, b - 1)
    capital = (buf[second] >= 65) & (buf[second] <= 90) & (b - a > 1)
    key = t.mix(tail + capital.astype(np.uint64))
    order = np.lexsort((key, row))
    g = t.group_starts(key[order], row[order])
    count = np.diff(np.concatenate([g, [len(order)]]))
    share = np.floor(np.log2(count / n_words[row[order][g]])).astype(np.int64)
    shape = t.mix(key[order][g] + (share + 64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order2 = np.lexsort((word, row))
    g2 = t.group_starts(word[order2], row[order2])
    distinct_row, distinct_word = row[order2][g2], word[order2][g2]
    fresh = np.bincount(distinct_row, minlength=n_rows)
    some = np.flatnonzero(n_words)
    repeat = np.floor(4 * np.log2(fresh[some] / n_words[some])).astype(np.int64)
    repeated = t.mix((repeat + 1000).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    rows = np.concatenate([distinct_row, row[order][g], some])
    places = (np.concatenate([distinct_word, shape, repeated]) % np.uint64(PLACES)).astype(np.int64)
    both = np.unique(rows * PLACES + places)
    return both // PLACES, both % PLACES


def association(row: np.ndarray, place: np.ndarray, grade: np.ndarray) -> np.ndarray:
    """Chi-square of each feature's presence against the grades."""
    size = np.bincount(grade, minlength=GRADES).astype(float)
    seen = np.stack([np.bincount(place[grade[row] == g], minlength=PLACES) for g in range(GRADES)], 1).astype(float)
    total = seen.sum(1, keepdims=True)
    want = total * size / size.sum()
    missing = size - seen
    want_missing = np.maximum(size - want, 1e-9)
    chi = ((seen - want) ** 2 / np.maximum(want, 1e-9) + (missing - (size - want)) ** 2 / want_missing).sum(1)
    return np.where(total[:, 0] >= OFTEN, chi, 0)  # with fewer documents chi-square means little


class CumulativeLink:
    """Shared weights and ordered thresholds."""

    def __init__(self):
        self.weight = np.zeros(PLACES, np.float32)
        self.cuts = np.array([-np.log(2.0), np.log(2.0)])
        self.fitted = False

    def fit(self, row: np.ndarray, place: np.ndarray, grade: np.ndarray, steps: int = 200, rate: float = 0.1, decay: float = 1e-4, told: float = TOLD) -> None:
        if len(set(grade.tolist())) < 2:
            return
        use = association(row, place, grade)[place] >= told
        row, place = row[use], place[use]
        names, col = np.unique(place, return_inverse=True)
        n = len(grade)
        w, cut, gap = np.zeros(len(names)), -1.0, 0.0  # the second threshold is cut + exp(gap)
        mean, spread = np.zeros(len(names) + 2), np.zeros(len(names) + 2)
        share = np.bincount(grade, minlength=GRADES) / n
        weigh = (1 / np.maximum(share, 1e-9) / (share > 0).sum())[grade] ** 0.5
        weigh /= weigh.mean()
        sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
        for step in range(1, steps + 1):
            f = np.bincount(row, w[col], n)
            cuts = np.array([cut, cut + np.exp(gap)])
            c = sig(cuts - f[:, None])  # P(grade <= k)
            c = np.concatenate([np.zeros((n, 1)), c, np.ones((n, 1))], 1)
            p = np.maximum(np.take_along_axis(np.diff(c, axis=1), grade[:, None], 1)[:, 0], 1e-9)
            d = c * (1 - c)
            at = np.arange(n)
            up, down = d[at, grade + 1], d[at, grade]
            to_f = (up - down) / p * weigh / n  # gradient of the loss
            g = np.empty(len(mean))
            g[:-2] = np.bincount(col, to_f[row], len(names)) + decay * w
            to_cut = np.stack([np.where(grade == 0, -up, np.where(grade == 1, down, 0)), np.where(grade == 1, -up, np.where(grade == 2, down, 0))]) / p * weigh / n
            g[-2] = to_cut.sum()
            g[-1] = to_cut[1].sum() * np.exp(gap)
            mean = 0.9 * mean + 0.1 * g
            spread = 0.99 * spread + 0.01 * g**2
            move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
            w -= move[:-2]
            cut -= move[-2]
            gap -= move[-1]
        self.weight[names] = w
        self.cuts = np.array([cut, cut + np.exp(gap)])
        self.fitted = True

    def grades(self, f: np.ndarray) -> np.ndarray:
        """P(grade = k) for each score."""
        c = 1 / (1 + np.exp(-np.clip(self.cuts - f[:, None], -500, 500)))
        return np.diff(np.concatenate([np.zeros((len(f), 1)), c, np.ones((len(f), 1))], 1), axis=1)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): the worst rating of each document."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(grade).alias("grade")).where("grade is not null")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> CumulativeLink:
    """Model from at most ``sample`` rated documents, the first in hash order."""
    chosen = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def fn(batches):
        for batch in batches:
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs):
                row, place = features(batch.column("text").slice(a, b - a))
                at = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(a, b - a), "grade": batch.column("grade").slice(a, b - a), "places": pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32)))})

    rated = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "grade")  # at most ``sample`` rows
    got = rated.mapInArrow(fn, "doc_id long, grade int, places array<int>").toArrow().sort_by("doc_id")
    model = CumulativeLink()
    if got.num_rows:
        size = t.lengths(got["places"])
        model.fit(np.repeat(np.arange(len(size)), size), got["places"].combine_chunks().flatten().to_numpy().astype(np.int64), got["grade"].to_numpy().astype(np.int64))
    return model


def score(docs: DataFrame, model: CumulativeLink, least: float = LEAST) -> DataFrame:
    """doc_id, expected_grade, tail_prob, toxic_prob, kept of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB

    def fn(batches):
        model = sent.value
        for batch in batches:
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs, 1 << 20):
                row, place = features(batch.column("text").slice(a, b - a))
                p = model.grades(np.bincount(row, model.weight[place], b - a))
                if not model.fitted:
                    p[:] = 1 / GRADES
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(a, b - a), "expected_grade": pa.array(p @ np.arange(GRADES)), "tail_prob": pa.array(p[:, 2]),
                    "toxic_prob": pa.array(p[:, 0]), "kept": pa.array((p[:, 2] >= least) & (p.argmax(1) > 0)),
                })

    return docs.select("doc_id", "text").mapInArrow(fn, "doc_id long, expected_grade double, tail_prob double, toxic_prob double, kept boolean")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document; a fifth of the ratings is held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return score(docs, train(docs, labels)).withColumn("held_out", held_out())
