"""Substring dedup by repeated-phrase automata.

A window is ``width`` consecutive words of one document; a word goes if it lies
in a window that also starts in a document with a smaller doc_id. Method:

1. Every window has an anchor, the least hash of its ``k``-word runs. Equal
   windows have equal anchors, so only windows whose anchor occurs in two
   documents can recur (about a fifth of all words send one hash).
2. Recurring windows are confirmed by a 128-bit hash of their words, with the
   smallest doc_id that has them.
3. Per block (shard) of documents, runs of confirmed windows with an earlier
   owner are its repeated passages; they become one Aho-Corasick automaton over
   the block's word numbers, and the block's documents are streamed through it
   to locate each occurrence. A passage's latest owner tells for which documents
   it is a repeat as a whole.

A hot phrase costs one entry per block in every exchange. Null and empty texts
give zero words and an empty text; rows that repeat a doc_id are judged one by
one and never remove each other's words; rows without doc_id are left out.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t
from eventlake.llm.blocks import ASKED, BLOCK_BYTES, TOLD, distinct_per_doc, in_blocks, recurring

WIDTH = 13
RUN = 4
OUT = "doc_id long, n_words long, n_removed long, kept_text string"


class Windows:
    """Words and windows of one block."""

    def __init__(self, table: pa.Table, width: int, run: int):
        t.release()
        self.doc_id = t.ids(table["doc_id"])
        self.buf, offs = t.text_bytes(table["text"])
        self.starts, self.ends, self.row = t.words(self.buf, offs)
        self.hash = t.span_hash(self.buf, self.starts, self.ends)
        self.width = width
        n = len(self.starts) - width + 1
        if n > 0:
            self.at = np.flatnonzero(self.row[:n] == self.row[width - 1 :])
            self.anchor = t.sliding_min(t.gram_hash(self.hash, run), width - run + 1)[self.at]
        else:
            self.at, self.anchor = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.doc = self.doc_id[self.row[self.at]]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and whether two documents of the block have them."""
        return distinct_per_doc(self.anchor, self.doc)

    def candidates(self, recurring: np.ndarray):
        """Places of the windows whose anchor recurs, in order of their two hashes, and where each distinct window begins there."""
        own, multi = self.anchors()
        known = np.sort(np.concatenate([own[multi], recurring]))
        at = np.flatnonzero(t.has(known, self.anchor))
        place, doc = self.at[at], self.doc[at]
        h1 = t.gram_hash(self.hash, self.width)[place] if len(place) else np.zeros(0, np.uint64)
        second = t.span_hash(self.buf, self.starts, self.ends, 1)
        h2 = t.gram_hash(second, self.width, 1)[place] if len(place) else np.zeros(0, np.uint64)
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        return h1, h2, doc[order], place[order], t.group_starts(h1, h2)


def _ask_anchors(width: int, run: int, slots: int):
    def fn(key, table):
        own, multi = Windows(table, width, run).anchors()
        return t.dealt(t.slot_of(own, slots), key[0].as_py(), {"hash": own, "multi": multi.astype(np.int64)})

    return fn


def _ask_windows(width: int, run: int, slots: int):
    def fn(docs, told):
        if docs.num_rows == 0:
            return _ask_schema_empty()
        h1, h2, doc, _, g = Windows(docs, width, run).candidates(t.longs(told["hash"]))
        h1, h2, least = h1[g], h2[g], np.minimum.reduceat(doc, g) if len(g) else doc
        return t.dealt(t.slot_of(h1, slots), docs["block"][0].as_py(), {"h1": h1, "h2": h2, "doc": least})

    return fn


def _ask_schema_empty() -> pa.Table:
    z = np.zeros(0, np.int64)
    return t.dealt(z, 0, {"h1": z, "h2": z, "doc": z})


def _first_owner(table):
    """Of one slot: to each block, the windows that a document with a smaller id elsewhere has."""
    t.release()
    h1, h2, doc = t.longs(table["h1"]), t.longs(table["h2"]), t.longs(table["doc"]).view(np.int64)
    src = np.repeat(t.ids(table["src"]), t.lengths(table["h1"]))
    order = np.lexsort((h2, h1))
    h1, h2, doc, src = h1[order], h2[order], doc[order], src[order]
    g = t.group_starts(h1, h2)
    least = np.repeat(np.minimum.reduceat(doc, g), np.diff(np.concatenate([g, [len(h1)]]))) if len(g) else doc
    tell = least < doc
    return t.dealt(src[tell], 0, {"h1": h1[tell], "h2": h2[tell], "doc": least[tell]}).drop(["src"])


def _owners(h1, h2, doc, g, told1, told2, owner) -> np.ndarray:
    """The smallest doc_id that has each candidate window: in the block, or as told."""
    if len(g) == 0:
        return doc
    least = np.minimum.reduceat(doc, g)
    size = np.diff(np.concatenate([g, [len(h1)]]))
    a, b = np.concatenate([h1[g], told1]), np.concatenate([h2[g], told2])
    order = np.lexsort((b, a))
    s = t.group_starts(a[order], b[order])
    lowest = np.minimum.reduceat(np.concatenate([least, owner])[order], s)
    back = np.empty(len(order), np.int64)
    back[order] = np.repeat(lowest, np.diff(np.concatenate([s, [len(order)]])))
    return np.repeat(back[: len(g)], size)


def _automaton(phrases: dict[tuple[int, ...], int]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for phrase, owner in phrases.items():
        made.add_word(phrase, (len(phrase), owner))
    made.make_automaton()
    return made


def _locate(width: int, run: int, carried: list[str]):
    def fn(docs, told):
        w = Windows(docs, width, run)
        kinds = t.ids(told["kind"])
        pick = lambda name, kind: t.longs(told.filter(pa.array(kinds == kind))[name])
        h1, h2, doc, place, g = w.candidates(pick("hash", 0))
        owner = _owners(h1, h2, doc, g, pick("h1", 1), pick("h2", 1), pick("doc", 1).view(np.int64))
        earlier = owner < doc
        order = np.argsort(place[earlier])
        place, owner = place[earlier][order], owner[earlier][order]
        go = np.zeros(len(w.starts), bool)
        if len(place):
            # passages: runs of windows one word apart; their latest owner decides for whom they are repeats
            new = np.ones(len(place), bool)
            new[1:] = (np.diff(place) != 1) | (w.row[place[1:]] != w.row[place[:-1]])
            first = np.flatnonzero(new)
            stop = place[np.concatenate([first[1:], [len(place)]]) - 1] + width
            latest = np.maximum.reduceat(owner, first)
            number = np.unique(w.hash, return_inverse=True)[1]
            phrases: dict[tuple[int, ...], int] = {}
            for a, b, who in zip(place[first].tolist(), stop.tolist(), latest.tolist(), strict=True):
                words = tuple(number[a:b].tolist())
                phrases[words] = min(who, phrases.get(words, who))
            made = _automaton(phrases)
            rows = np.searchsorted(w.row, np.arange(len(w.doc_id) + 1))
            begin, size = [], []
            for r in np.unique(w.row[place]).tolist():
                a, b, who = int(rows[r]), int(rows[r + 1]), int(w.doc_id[r])
                for end, (n, owner_of) in made.iter(tuple(number[a:b].tolist())):
                    if owner_of < who:
                        begin.append(a + end - n + 1)
                        size.append(n)
            go = t.covered(np.array(begin, np.int64), np.array(size, np.int64), len(w.starts))
        n = len(w.doc_id)
        keep = ~go
        return pa.table({
            "doc_id": pa.array(w.doc_id),
            "n_words": pa.array(np.bincount(w.row, minlength=n).astype(np.int64)),
            "n_removed": pa.array(np.bincount(w.row[go], minlength=n).astype(np.int64)),
            "kept_text": t.join_words(w.buf, w.starts[keep], w.ends[keep], w.row[keep], n),
            **{c: docs[c] for c in carried},
        })

    return fn


def substring_dedup(docs: DataFrame, width: int = WIDTH, run: int = RUN, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text of every row of ``docs`` (doc_id, text).

    With ``carry`` the row's columns of these names come along as a struct ``_row``.
    """
    carried = [] if carry is None else ["_row"]
    if carry is not None:
        docs = docs.withColumn("_row", F.struct(*carry))
    blocks, _, slots = in_blocks(docs, block_bytes, *carried)
    out = OUT + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carried)
    asked = blocks.groupBy("block").applyInArrow(_ask_anchors(width, run, slots), ASKED)
    again = asked.groupBy("slot").applyInArrow(recurring, TOLD)
    windows = blocks.groupBy("block").cogroup(again.groupBy("slot")).applyInArrow(
        _ask_windows(width, run, slots), "slot int, src int, h1 array<bigint>, h2 array<bigint>, doc array<bigint>"
    )
    owners = windows.groupBy("slot").applyInArrow(_first_owner, "slot int, h1 array<bigint>, h2 array<bigint>, doc array<bigint>")
    none = F.array().cast("array<bigint>")
    told = again.select("slot", F.lit(0).alias("kind"), "hash", none.alias("h1"), none.alias("h2"), none.alias("doc")).unionAll(
        owners.select("slot", F.lit(1), none, "h1", "h2", "doc")
    )
    return blocks.groupBy("block").cogroup(told.groupBy("slot")).applyInArrow(_locate(width, run, carried), out)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that an earlier document has."""
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with the repeated words cut out of their texts."""
    kept = substring_dedup(docs, carry=[c for c in docs.columns if c != "text"])
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[(new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns])
