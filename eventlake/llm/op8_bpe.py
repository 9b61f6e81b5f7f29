"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch are visited in sorted order, which is a
depth-first walk over their trie: what is kept for each prefix is the last
token of its encoding, so a prefix that many words share is encoded once. A
token may follow another when encoding the two together gives these two again;
a sequence of tokens is the encoding of a word exactly if each neighbouring
pair may stand so, hence one last token per prefix is all the state there is.

The vocabulary is a word-end BPE file in the tokenizers JSON format: NFC,
white space, lower case, words by pattern, bytes as printable characters.
Special tokens in a text stand for their ids. Decoding joins the token strings
by one space, as the file names no decoder. Null and empty texts give no ids
and an empty string; rows that repeat are encoded each; any doc_id, null too.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import textops as t

assert sys.byteorder == "little" and array("I").itemsize == 4
END = "\ue000"  # stands for the word-end suffix inside token strings
PAIRS_KEPT = 800_000
WORDS_KEPT = 300_000
_LOADED: dict[int, BpeTrie] = {}


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable Latin-1, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class BpeTrie:
    """Encoder and decoder of one vocabulary file; keeps bounded caches between batches."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.text_of = {i: s for s, i in model["vocab"].items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.plain = re.compile(split.replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}\p{N}", "a-z0-9"), re.ASCII)
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.text_of |= {i: s for s, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        inner = lambda s: s[: -len(suffix)] + END if s.endswith(suffix) else s
        self.id_of = {inner(s): i for s, i in model["vocab"].items()}
        self.made: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.age = {i: -1 for i in self.id_of.values()}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, both = self.id_of[inner(a)], self.id_of[inner(b)], self.id_of[inner(a + b)]
            if self.age[both] < 0:
                self.made[left, right], self.parts[both], self.age[both] = both, (left, right), rank
        # only a token that its own merges give can stand in an encoding
        self.own = {s: i for s, i in self.id_of.items() if i not in self.parts or self._apart_inside(i)}
        # the tokens of two letters or more by their last two letters: lengths, the longest first
        inside: dict[str, set[int]] = {}
        final: dict[str, set[int]] = {}
        for s in self.own:
            if s.endswith(END):
                final.setdefault(s[-3:], set()).add(len(s) - 1)
            else:
                inside.setdefault(s[-2:], set()).add(len(s))
        self.inside = {s: sorted(n - {1}, reverse=True) for s, n in inside.items()}
        self.final = {s: sorted(n - {1}, reverse=True) for s, n in final.items()}
        self.pairs: dict[int, bool] = {}
        self.packed: dict[str, bytes] = {}
        self.shown: dict[str, str] = {}

    def _apart_inside(self, token: int) -> bool:
        left, right = self.parts[token]
        return self.stay_apart(left, right, self.age[token])

    def stay_apart(self, left: int, right: int, bound: float = float("inf")) -> bool:
        """Whether no merge across the boundary of two tokens comes before ``bound`` while both are being made.

        The merges that made them are undone from the youngest: ``a`` and ``b``
        are the tokens next to the boundary at that time, and a merge of these
        two would have been taken if it is older than the one just undone (at
        equal age the leftmost is taken first).
        """
        a, b, age, parts, made = left, right, self.age, self.parts, self.made
        while True:
            both = made.get((a, b))
            if both is not None and age[both] < bound:
                return False
            if a in parts and (b not in parts or age[a] > age[b]):
                bound = age[a]
                a = parts[a][1]
            elif b in parts:
                bound = age[b] + 0.5
                b = parts[b][0]
            else:
                return True

    def follows(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.stay_apart(left, right)
        return known

    def spelled(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.letters[b] for b in word.encode("utf-8", "surrogatepass")])

    def encode_words(self, words: Iterable[str]) -> None:
        """Adds packed ids and decoded text of the distinct words to the caches."""
        own, inside, final, follows = self.own, self.inside, self.final, self.follows
        # state of the walk: for each prefix length, its last token and that token's length
        last, size, before = [-1], [0], ""
        for path, word in sorted([(self.spelled(w), w) for w in words]):
            shared, top = 0, min(len(path), len(last) - 1)
            while shared < top and path[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            total = len(path)
            for n in range(shared + 1, total):
                for k in inside.get(path[n - 2 : n], ()) if n > 1 else ():
                    if k <= n:
                        token = own.get(path[n - k : n])
                        if token is not None and (k == n or follows(last[n - k], token)):
                            break
                else:
                    token, k = own[path[n - 1]], 1
                last.append(token)
                size.append(k)
            whole = path + END
            for k in final.get(whole[-3:], ()) if total > 1 else ():
                if k <= total:
                    token = own.get(whole[total - k :])
                    if token is not None and (k == total or follows(last[total - k], token)):
                        break
            else:
                token, k = own[whole[-2:]], 1
            out = [token]
            n = total - k
            while n:
                out.append(last[n])
                n -= size[n]
            out.reverse()
            before = path
            self.packed[word] = array("I", out).tobytes()
            self.shown[word] = self.decode(out)

    def decode(self, token_ids: Iterable[int]) -> str:
        return " ".join([self.text_of[i] for i in token_ids if i in self.text_of])

    def words(self, text: str) -> list[str]:
        # lower case letter by letter: no final-sigma rule
        if text.isascii():
            return self.plain.findall(text.lower())
        return self.pattern.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids as little-endian 32-bit integers, and the decoded text, of each text."""
        split: list[list] = []
        for text in texts:
            if self.cut and "<" in text and self.cut.search(text):
                split.append([x for part in self.cut.split(text) for x in ([self.special[part]] if part in self.special else self.words(part))])
            else:
                split.append(self.words(text))
        strange = {w for ws in split for w in ws if w.__class__ is int}
        new = {w for ws in split for w in ws} - strange
        if len(self.packed) + len(new - self.packed.keys()) > WORDS_KEPT:
            self.packed.clear()
            self.shown.clear()
        self.encode_words(new - self.packed.keys())
        for w in strange:
            self.packed[w], self.shown[w] = array("I", [w]).tobytes(), self.text_of[w]
        return [b"".join(map(self.packed.__getitem__, ws)) for ws in split], [" ".join(map(self.shown.__getitem__, ws)) for ws in split]


def _trie(source: str) -> BpeTrie:
    key = hash(source)
    if key not in _LOADED:
        _LOADED[key] = BpeTrie(source)
    return _LOADED[key]


def bpe_encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, token_ids (packed little-endian 32-bit), n_tokens, decoded of every row of ``docs``.

    ``vocabulary`` is the path of the JSON file on the driver; its text (a fixed
    size of a few MB) goes to the tasks as a broadcast variable.
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def fn(batches):
        trie = _trie(source.value)
        for batch in batches:
            _, offs = t.text_bytes(batch.column("text"))
            for a, b in t.pieces(offs, 1 << 20):
                part = batch.slice(a, b - a)
                ids, decoded = trie.encode([x or "" for x in part.column("text").to_pylist()])
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
                    "token_ids": pa.array(ids, pa.binary()),
                    "decoded": pa.array(decoded, pa.string()),
                })

    return docs.select("doc_id", "text").mapInArrow(fn, "doc_id long, n_tokens long, token_ids binary, decoded string")


def _digests(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    return _digests(bpe_encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_vocabulary()))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): each document's token ids."""
    return bpe_encode(docs, default_vocabulary()).select("doc_id", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))
