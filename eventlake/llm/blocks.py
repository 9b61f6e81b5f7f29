"""Documents dealt to blocks of bounded size, and the exchange of their keys.

A block holds about ``BLOCK_BYTES`` of text, whatever the size of the corpus;
several stages of one operator read the same blocks (Spark reuses the
exchange). Stages answer questions about all documents by sending hashes,
pre-aggregated per block, to hash slots and the answers back to the blocks, so
a key that a third of all rows share costs one entry per block.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm import textops as t

BLOCK_BYTES = 2 << 20
ASKED = "slot int, src int, hash array<bigint>, multi array<bigint>"
TOLD = "slot int, hash array<bigint>"


def text_size(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, *extra: str) -> tuple[DataFrame, int, int]:
    """(doc_id, text, *extra, block), the number of blocks and of hash slots.

    Rows without a doc_id can't be referred to and are left out.
    """
    docs = docs.where("doc_id is not null").select("doc_id", "text", *extra)
    n = max(1, math.ceil(text_size(docs) / block_bytes))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block")
    return docs.select("doc_id", "text", *extra, block), n, max(1, n // 4)


def distinct_per_doc(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of a block, and whether two of its documents have them."""
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    h, d = hashes[new], docs[new]
    order = np.argsort(h)
    h, d = h[order], d[order]
    at = t.group_starts(h)
    if len(at) == 0:
        return h, np.zeros(0, bool)
    return h[at], np.minimum.reduceat(d, at) < np.maximum.reduceat(d, at)


def recurring(table):
    """Of one hash slot: to each block, those of its hashes that another block, or two documents of one block, have.

    A block knows by itself which of its hashes two of its documents have.
    """
    h, multi = t.longs(table["hash"]), t.longs(table["multi"]).astype(bool)
    src = np.repeat(t.ids(table["src"]), t.lengths(table["hash"]))
    order = np.argsort(h)
    h, multi, src = h[order], multi[order], src[order]
    g = t.group_starts(h)
    size = np.diff(np.concatenate([g, [len(h)]]))
    again = np.repeat((size > 1) | np.logical_or.reduceat(multi, g), size) if len(g) else np.zeros(0, bool)
    again &= ~multi
    return t.dealt(src[again], 0, {"hash": h[again]}).drop(["src"])
