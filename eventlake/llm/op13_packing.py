"""Packing of token sequences into windows: bounded-space online packing.

Each task reads its documents in order and keeps ``OPEN`` windows. What a
document has beyond whole windows is placed best-fit: into the open window it
leaves least room in. When none has room, the fullest is topped up with the
head of the piece and emitted, and a window is opened for the rest; so no
emitted window has padding. At the end of a task its open windows are its
leftovers. They merge in groups of ``MERGE`` tasks, level by level, with the
same packing, until one group is left; its ids are poured into full windows, and
the last rest becomes sequences whose lengths are powers of two. No length of
document, number of documents or number of tasks changes what a task holds: one
document, ``OPEN`` windows and an encoder cache of bounded size.

Ids come from the tokenizers library, each distinct word once: a text is split
at white space, ASCII punctuation and digits, where the vocabulary's pattern
splits it too; a chunk with an apostrophe, a special token, control bytes or
characters beyond Latin-1 letters is encoded whole. With any other pattern whole
texts are encoded.

Every row is packed: a null text is an empty one and holds only the end id; rows
that repeat, null ids and ties are packed row by row; an empty table gives no
piece. Further columns are left out.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.components import written
from eventlake.llm.op8_bpe import default_vocabulary

WINDOW, END_ID = 2048, 1
#: windows a task keeps open, tasks whose leftovers meet, and words an encoder remembers
OPEN, MERGE, WORDS_KEPT = 8, 32, 1_000_000
PIECE = "part long, level int, doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
# The pattern after which a text may be split before it is encoded.
SPLITS_AT_CLASSES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_LETTER, _DIGIT, _MARK, _WHOLE = 1, 2, 3, 4
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[128:] = _CLASS[:9] = _CLASS[14:32] = _WHOLE
_CLASS[[39, 127]] = _WHOLE  # the apostrophe may begin a contraction
_ENCODERS: dict[int, Encoder] = {}


def units(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, rows, whole) of the runs that are encoded independently.

    The bytes are lower-cased but in the chunks marked ``whole``.
    """
    cls, low = _CLASS[buf], t.lower_ascii(buf)
    after_c3 = np.zeros(len(buf), bool)
    after_c3[1:] = buf[:-1] == 0xC3
    if after_c3.any():  # Latin-1 letters: both bytes, and upper case 32 before lower case
        at = np.flatnonzero(after_c3 & (buf != 0x97) & (buf != 0xB7))
        cls[at] = cls[at - 1] = _LETTER
        up = at[buf[at] < 0x9F]
        low[up] = buf[up] + np.uint8(32)
    cls[:-1][(buf[:-1] == 60) & (buf[1:] == 124)] = _WHOLE  # a special token begins
    first = offs[:-1][offs[:-1] < offs[1:]]
    odd = np.flatnonzero(cls == _WHOLE)
    if len(odd):  # mark the chunks between white space that hold such a byte
        bounds = np.unique(np.concatenate([np.flatnonzero(cls == 0), first, [len(buf)]]))
        k = np.unique(np.searchsorted(bounds, odd, "right"))
        lo = np.where(k > 0, bounds[k - 1], 0)
        lo = lo + (cls[lo] == 0)
        size = bounds[k] - lo
        inside = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        cls[inside] = _WHOLE
        low[inside] = buf[inside]
    edge = np.ones(len(buf), bool)
    edge[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == _DIGIT)
    edge[first] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(buf))
    real = cls[starts] != 0
    starts, ends = starts[real], ends[real]
    return low, starts, ends, np.searchsorted(offs, starts, "right") - 1, cls[starts] == _WHOLE


class Encoder:
    """Ids of many texts by the tokenizers library; distinct words are encoded once while they are remembered."""

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        spec = json.loads(source)
        self.full = Tokenizer.from_str(source)
        self.full.no_truncation()
        self.full.no_padding()
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_units = bool(suffix) and steps[0].get("pattern", {}).get("Regex") == SPLITS_AT_CLASSES
        if self.by_units:
            self.bare = Tokenizer.from_str(source)
            self.bare.no_truncation()
            self.bare.no_padding()
            self.bare.normalizer = normalizers.Sequence([])
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), level])
            self.last = np.zeros(self.full.get_vocab_size(), bool)
            self.last[[i for s, i in spec["model"]["vocab"].items() if s.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[int, int] = {}
        self.check = np.zeros(1024, np.uint64)
        self.at, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _room(self, n_words: int, n_ids: int) -> None:
        if n_words > len(self.at):
            grow = max(n_words, 2 * len(self.at))
            self.check, self.at, self.size = (np.resize(a, grow) for a in (self.check, self.at, self.size))
        if n_ids > len(self.ids):
            self.ids = np.resize(self.ids, max(n_ids, 2 * len(self.ids)))

    def _learn(self, words: list[str], whole: np.ndarray, hashes: list[int], check: np.ndarray) -> None:
        """Encode new words and remember their ids."""
        found: list[np.ndarray] = []
        sizes = np.zeros(len(words), np.int64)
        plain = np.flatnonzero(~whole)
        for a in range(0, len(plain), 256):
            some = plain[a : a + 256]
            lines = self.bare.encode_batch_fast([" ".join([words[i] for i in some])], add_special_tokens=False)
            ids = np.array(lines[0].ids, np.int64)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                raise AssertionError("a word of the vocabulary's pattern has no last token")
            sizes[some] = np.diff(ends, prepend=0)
            found.append(ids)
        for i in np.flatnonzero(whole):
            ids = np.array(self.full.encode(words[i], add_special_tokens=False).ids, np.int64)
            sizes[i] = len(ids)
            found.append(ids)
        order = np.concatenate([plain, np.flatnonzero(whole)])
        n, total = len(self.slot), int(sizes.sum())
        self._room(n + len(words), self.used + total)
        slots = np.empty(len(words), np.int64)
        slots[order] = n + np.arange(len(words))
        size = sizes[order]
        self.at[n : n + len(words)] = self.used + np.cumsum(size) - size
        self.size[n : n + len(words)] = size
        self.check[n : n + len(words)] = check[order]
        if total:
            self.ids[self.used : self.used + total] = np.concatenate(found)
        self.used += total
        self.slot.update(zip(hashes, slots.tolist(), strict=True))

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per text) of an Arrow string column."""
        buf, offs = t.text_bytes(column)
        if not self.by_units or not len(buf):
            texts = [x or "" for x in column.to_pylist()] if len(buf) else []
            each = [np.array(self.full.encode(x, add_special_tokens=False).ids, np.uint32) for x in texts]
            sizes = np.array([len(x) for x in each], np.int64) if texts else np.zeros(len(offs) - 1, np.int64)
            return np.concatenate([np.zeros(0, np.uint32), *each]), sizes
        low, starts, ends, rows, whole = units(buf, offs)
        hashes = t.span_hash(low, starts, ends)
        # the first eight bytes and the length, so that a word of another hash class can't pass for it
        eight = np.concatenate([low, np.zeros(8, np.uint8)])
        head = np.lib.stride_tricks.as_strided(eight, (len(low) + 1, 8), (1, 1))[starts].copy().view(np.uint64)[:, 0]
        short = np.minimum(ends - starts, 8).astype(np.uint64)
        check = (head << ((t.U64(8) - short) * t.U64(8))) ^ ((ends - starts).astype(np.uint64) << t.U64(1)) ^ whole.astype(np.uint64)
        codes, distinct = pd.factorize(hashes)
        rep = np.empty(len(distinct), np.int64)
        rep[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if (check[rep][codes] != check).any():
            return self._whole_texts(column)
        keys = distinct.tolist()
        if len(self.slot) + len(keys) > WORDS_KEPT:
            self._forget()
        get = self.slot.get
        new = [i for i, k in enumerate(keys) if k not in self.slot]
        if new:
            take = rep[new]
            data = low.tobytes()
            words = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[take].tolist(), ends[take].tolist(), strict=True)]
            self._learn(words, whole[take], [keys[i] for i in new], check[take])
        slots = np.fromiter(map(get, keys), np.int64, len(keys))
        if (self.check[slots] != check[rep]).any():
            return self._whole_texts(column)
        at, size = self.at[slots][codes], self.size[slots][codes]
        total = int(size.sum())
        ids = self.ids[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(total)]
        return ids, np.bincount(rows, size, len(offs) - 1).astype(np.int64)

    def _whole_texts(self, column) -> tuple[np.ndarray, np.ndarray]:
        """For texts whose words can't be told apart by hash and check."""
        each = [np.array(self.full.encode(x or "", add_special_tokens=False).ids, np.uint32) for x in column.to_pylist()]
        return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)


def _encoder(source: str) -> Encoder:
    key = hash(source)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(source)
    return _ENCODERS[key]


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids, doc_tokens); closed ones wait in ``out``."""

    def __init__(self, part: int, level: int, window: int = WINDOW, n_open: int = OPEN):
        self.part, self.level, self.window, self.n_open = part, level, window, n_open
        self.open: list[list] = []  # [room, pieces]
        self.out: list[tuple] = []
        self.closed = 0

    def _emit(self, pieces: list[tuple], kept: bool = False) -> None:
        """The pieces of one sequence; ``kept``: of an open window, for the next level."""
        number = -1 if kept else (self.level << 58) | (self.part << 32) | self.closed
        self.closed += not kept
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((self.part, self.level + 1 if kept else -1, doc, start, len(ids), total, number, at, ids.tobytes()))
            at += len(ids)

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.window:
            self._emit([(doc, start, ids[: self.window], total)])
            start, ids = start + self.window, ids[self.window :]
        while len(ids):
            n = len(ids)
            fits = [w for w in self.open if w[0] >= n]
            if fits:
                best = min(fits, key=lambda w: w[0])
            elif len(self.open) < self.n_open:
                best = [self.window, []]
                self.open.append(best)
            else:
                best = min(self.open, key=lambda w: w[0])
            head = ids[: best[0]]
            best[1].append((doc, start, head, total))
            best[0] -= len(head)
            start, ids = start + len(head), ids[len(head) :]
            if best[0] == 0:
                self._emit(best[1])
                self.open = [w for w in self.open if w is not best]

    def leave(self) -> None:
        """The open windows as pieces for the next level."""
        for _, pieces in self.open:
            self._emit(pieces, kept=True)
        self.open = []

    def pour(self) -> None:
        """The last level: all open windows into full ones, the rest into sequences of powers of two."""
        pieces = [p for _, window in sorted(self.open, key=lambda w: w[0]) for p in window]
        self.open = []
        left = sum(len(p[2]) for p in pieces)
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= size
            mine = []
            while size:
                doc, start, ids, total = pieces.pop(0)
                if len(ids) > size:
                    pieces.insert(0, (doc, start + size, ids[size:], total))
                    ids = ids[:size]
                mine.append((doc, start, ids, total))
                size -= len(ids)
            self._emit(mine)

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = ("part", "level", "doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
        cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], list(names))


def _pack_texts(source, window: int, n_open: int):
    def fn(batches):
        encoder, packer = _encoder(source.value), None
        for batch in batches:
            if packer is None and batch.num_rows:
                packer = Packer(batch.column("part")[0].as_py(), 0, window, n_open)
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs, 4 << 20):
                part = batch.slice(a, b - a)
                ids, sizes = encoder.encode(part.column("text"))
                ends = np.cumsum(sizes)
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
                    whole = np.append(ids[lo:hi], np.uint32(END_ID))
                    packer.add(doc, 0, whole, len(whole))
                yield packer.taken()
        if packer is not None:
            packer.leave()
            yield packer.taken()

    return fn


def _pack_left(level: int, last: bool, window: int, n_open: int):
    def fn(key, table):
        """Leftovers of some tasks of the level before: the largest pieces first."""
        packer = Packer(key[0].as_py(), level, window, n_open)
        rows = list(zip(*[table[c].to_pylist() for c in ("length", "doc_id", "start", "doc_tokens", "ids", "part")], strict=True))
        rows.sort(key=lambda r: (-r[0], r[5], r[1] is None, r[1] or 0, r[2], r[4]))
        for _, doc, start, total, ids, _ in rows:
            packer.add(doc, start, np.frombuffer(ids, np.uint32), total)
        packer.pour() if last else packer.leave()
        return pa.Table.from_batches([packer.taken()])

    return fn


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, n_open: int = OPEN) -> DataFrame:
    """Pieces doc_id, start, length, doc_tokens, sequence_id, offset, ids (packed little-endian 32-bit) of all rows.

    ``vocabulary`` is the path of the tokenizers JSON file on the driver; its
    text (a fixed size of a few MB) goes to the tasks as a broadcast variable.
    The first packing is written to the shared scratch folder, leftovers of each
    level too: a few windows for each task of the level before.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().cast("long").alias("part"))
    packed = written(rows.mapInArrow(_pack_texts(source, window, n_open), PIECE), "packed", "zstd")
    out, level, more = [packed.where("level = -1")], 1, packed.where("level = 1")
    while True:
        tasks = more.agg(F.max("part")).first()[0]
        if tasks is None:
            break
        last = tasks < MERGE
        grouped = more.withColumn("group", F.floor(F.col("part") / MERGE).cast("long")).groupBy("group")
        step = written(grouped.applyInArrow(_pack_left(level, last, window, n_open), PIECE), "packed-left", "zstd")
        out.append(step.where("level = -1"))
        if last:
            break
        level += 1
        more = step.where(F.col("level") == level)
    whole = out[0]
    for step in out[1:]:
        whole = whole.unionAll(step)
    return whole.drop("part", "level")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in sequences of at most 2048, as pieces with a checksum of their ids."""
    pieces = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
