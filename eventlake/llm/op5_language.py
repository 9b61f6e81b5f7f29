"""Language identification by a byte convolutional network.

Texts are cut into windows of ``WINDOW`` bytes. A window's bytes are embedded,
filters two to four bytes wide run over them, each filter's largest response
is kept (max pooling) and a softmax layer gives a probability per language.
The network is trained in numpy on a bounded sample of labelled documents
(``per_lang`` documents a language, ``per_doc`` windows of each); every whole
text is then scored in batches of windows, and a document's probabilities are
the mean over its windows, weighted by their bytes.

Null texts and texts without a letter are ``und`` with score 0; repeated rows
are scored one by one; without any labelled row every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm import textops as t

WINDOW = 256
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
FILTERS = 12
DIM = 6
UNKNOWN = "und"
#: bound of the training sample: documents per language, windows per document
PER_LANG, PER_DOC = 400, 6


class ByteCnn:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, langs: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.langs = langs
        self.embed = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.kernel = rng.normal(0, 0.3, ((REACH + 1) * DIM, n)).astype(np.float32)
        # a narrower filter has zeros beyond its width
        self.mask = np.concatenate([np.repeat(np.arange(REACH + 1) < w, DIM)[:, None].repeat(FILTERS, 1) for w in WIDTHS], 1).astype(np.float32)
        self.kernel *= self.mask
        self.bias = np.zeros(n, np.float32)
        self.out = rng.normal(0, 0.1, (n, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def _columns(self, windows: np.ndarray) -> np.ndarray:
        e = self.embed[windows]
        return np.concatenate([e[:, j : j + WINDOW] for j in range(REACH + 1)], 2)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def probabilities(self, windows: np.ndarray, at_once: int = 96) -> np.ndarray:
        """One row of probabilities per window of WINDOW + REACH bytes."""
        pooled = np.empty((len(windows), len(self.bias)), np.float32)
        for a in range(0, len(windows), at_once):
            x = self._columns(windows[a : a + at_once])
            z = (x.reshape(-1, x.shape[2]) @ self.kernel).reshape(len(x), WINDOW, -1)
            n = WINDOW
            while n > 1:
                n //= 2
                z = np.maximum(z[:, :n], z[:, n : 2 * n])
            pooled[a : a + len(x)] = z[:, 0]
        return self._softmax(pooled + self.bias)

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        names = ("embed", "kernel", "bias", "out", "out_bias")
        mean = {k: np.zeros_like(getattr(self, k)) for k in names}
        spread = {k: np.zeros_like(getattr(self, k)) for k in names}
        steps = 0
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
                w, y = windows[at], labels[at]
                n = len(at)
                x = self._columns(w)
                z = (x.reshape(-1, x.shape[2]) @ self.kernel).reshape(n, WINDOW, -1)
                best = z.argmax(1)
                rows = np.arange(n)[:, None]
                pooled = z[rows, best, np.arange(z.shape[2])] + self.bias
                p = self._softmax(pooled)
                p[np.arange(n), y] -= 1
                p /= n
                hidden = np.maximum(pooled, 0)
                g = {"out": hidden.T @ p, "out_bias": p.sum(0)}
                back = (p @ self.out.T) * (pooled > 0)
                g["bias"] = back.sum(0)
                chosen = x[rows, best]
                g["kernel"] = np.einsum("nf,nfk->kf", back, chosen) * self.mask
                to_embed = np.einsum("nf,kf->nfk", back, self.kernel).reshape(n, -1, REACH + 1, DIM)
                g["embed"] = np.zeros_like(self.embed)
                np.add.at(g["embed"], w[rows[:, :, None], best[:, :, None] + np.arange(REACH + 1)], to_embed)
                steps += 1
                for k in names:
                    mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                    spread[k] = 0.999 * spread[k] + 0.001 * g[k] ** 2
                    step = rate * (mean[k] / (1 - 0.9**steps)) / (np.sqrt(spread[k] / (1 - 0.999**steps)) + 1e-8)
                    setattr(self, k, (getattr(self, k) - step).astype(np.float32))


def cut(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of each text (one at least unless it is empty), their rows and sizes; short ones end in spaces."""
    size = np.diff(offs)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    start = offs[:-1][row] + WINDOW * (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count))
    index = start[:, None] + np.arange(WINDOW + REACH)
    end = offs[1:][row]
    low = t.lower_ascii(buf)
    windows = np.where(index < end[:, None], low[np.minimum(index, max(0, len(buf) - 1))], np.uint8(32)) if len(row) else np.zeros((0, WINDOW + REACH), np.uint8)
    return windows, row, np.minimum(end - start, WINDOW)


def _has_letter(column) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def train(labelled: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC) -> ByteCnn | None:
    """Network from a bounded sample of (doc_id, text, lang): ``per_lang`` documents a language by hash order."""
    usable = labelled.where("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_lang)

    def fn(batches):
        for batch in batches:
            buf, offs = t.text_bytes(batch.column("text"))
            windows, row, _ = cut(buf, offs)
            row = row[_has_letter(batch.column("text"))[row]] if len(row) else row
            at = np.concatenate([np.linspace(a, b - 1, min(per_doc, b - a)).astype(int) for a, b in zip(*_runs(row), strict=True)] or [np.zeros(0, int)])
            yield pa.record_batch({
                "lang": batch.column("lang").take(pa.array(row[at])),
                "doc_id": batch.column("doc_id").take(pa.array(row[at])),
                "window": pa.array([w.tobytes() for w in windows[at]], pa.binary()),
            })

    rows = usable.join(F.broadcast(chosen.select("doc_id", "lang")), ["doc_id", "lang"]).select("doc_id", "text", "lang").mapInArrow(fn, "lang string, doc_id long, window binary")
    got = rows.toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending"), ("window", "ascending")])
    if got.num_rows == 0:
        return None
    langs = sorted(set(got["lang"].to_pylist()))
    number = {k: i for i, k in enumerate(langs)}
    net = ByteCnn(langs)
    net.fit(np.stack([np.frombuffer(w, np.uint8) for w in got["window"].to_pylist()]), np.array([number[k] for k in got["lang"].to_pylist()]))
    return net


def _runs(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = t.group_starts(row)
    return at, np.concatenate([at[1:], [len(row)]]) if len(at) else at


def predict(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    """doc_id, lang_pred, score of every row; only the text is read."""
    sent = docs.sparkSession.sparkContext.broadcast(net)  # a few KB

    def fn(batches):
        net = sent.value
        for batch in batches:
            t.release()
            buf, offs = t.text_bytes(batch.column("text"))
            letter = _has_letter(batch.column("text"))
            for a, b in t.pieces(offs, 1 << 20):
                n = b - a
                lang, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if net is not None:
                    windows, row, size = cut(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                    total = np.zeros((n, len(net.langs)))
                    p = net.probabilities(windows) * size[:, None]
                    for k in range(len(net.langs)):
                        total[:, k] = np.bincount(row, p[:, k], n)
                    total /= np.maximum(1, np.diff(offs[a : b + 1]))[:, None]
                    ok = letter[a:b]
                    lang[ok] = np.array(net.langs, object)[total.argmax(1)[ok]]
                    score[ok] = np.clip(total.max(1)[ok], 0, 1)
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(a, n), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    return docs.select("doc_id", "text").mapInArrow(fn, "doc_id long, lang_pred string, score double")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a quarter of them is held out from training."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = predict(docs, train(docs.where(~held_out())))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: a document whose mean probability is below this is in no learned language
LEAST = 0.3


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in a learned language; those without letters or a likely language go."""
    told = predict(docs, train(docs.where(~held_out()))).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST))
    return docs.join(told.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
