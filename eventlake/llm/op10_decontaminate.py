"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

Native: DataFrame functions only. A document is contaminated by a benchmark
item of m words if one of its windows of m words has a weighted similarity of
``THRESHOLD`` or more to it: over five-word shingles (A-Z lowered; the whole
sequence if it is shorter), the sum of the smaller multiplicities divided by
the sum of the larger ones. Method:

1. Places: at similarity 0.75 at most a seventh of an item's n shingles is
   lost, and each lost word loses one at least; to a text shorter than the item, a
   quarter. So of the n // 4 + 3 longest distinct words of an item all but n // 7
   (n // 4) stand in the window, in any order; all windows that hold so many, and
   all but n // 7 (n // 4) of all its distinct words, are looked at.
2. The windows of the item's size at these places get a 64-bit SimHash of their
   words.
3. Multi-index: fingerprints are cut into 16 blocks of 4 bits; the items'
   blocks are indexed with all their one-bit neighbours, which guarantees every
   item within a Hamming distance of 31, which is ``RADIUS``.
4. Candidates are verified by the exact weighted shingle similarity.

Null and empty texts and items match nothing; equal items each report; a tie
between windows goes to the earliest. Rows without doc_id or item_id are left
out; rows that share a doc_id count as one document with several texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.components import written

SHINGLE = 5
THRESHOLD = 0.75
RADIUS = 31
BLOCKS, BITS = 16, 4
#: rows and bytes (as text) that may be broadcast; beyond either Spark joins by shuffle
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
_LANES = 0x0000000100000001


def words_of(text: str) -> Column:
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(low, "[ \\x09-\\x0D]+"), lambda w: w != "")


def _words(text: str) -> Column:
    """As :func:`words_of`, without a pass over the words: only the ends of a split can be empty."""
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(low, "^[ \\x09-\\x0D]+|[ \\x09-\\x0D]+$", ""), "[ \\x09-\\x0D]+")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if its size, which is checked, allows; a plain join otherwise."""
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def _shingles(words: str) -> Column:
    """Array of the shingles of an array of words."""
    n = F.size(words)
    last = F.greatest(n - SHINGLE, F.lit(0))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " "))).otherwise(F.array().cast("array<string>"))


def _fingerprint(rows: DataFrame, key: list[str]) -> DataFrame:
    """SimHash of each key's words; rows: key columns and one ``word`` each.

    Bit b is set if more than half of the words' hashes have it. Two counters
    of 32 bits share a long, so 32 sums count all 64 bits.
    """
    h = F.xxhash64("word")
    lane = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_LANES))).alias(f"s{j}") for j in range(32)]
    sums = rows.groupBy(*key).agg(F.count("*").alias("n"), *lane)
    bits = [
        F.shiftleft(F.when(2 * F.shiftrightunsigned(f"s{j}", 32 * k).bitwiseAND(F.lit(0xFFFFFFFF)) > F.col("n"), F.lit(1)).otherwise(F.lit(0)).cast("long"), 32 * k + j)
        for j in range(32)
        for k in range(2)
    ]
    return sums.select(*key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("print"))


def _block(j: int) -> Column:
    return F.shiftrightunsigned("print", BITS * j).bitwiseAND(F.lit((1 << BITS) - 1))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start (first word of the best window), n_words, similarity of every contamination."""
    items = benchmark.where("item_id is not null").select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    items = items.withColumn("m", F.size("words")).withColumn("n", F.greatest(F.col("m") - SHINGLE, F.lit(0)) + 1)
    items = items.withColumn("lost", F.expr("cast(n div 7 as int)")).withColumn("cut", F.expr("cast(n div 4 as int)")).drop("n")

    # 1. places by the longest words
    word = items.select("item_id", "m", "lost", "cut", F.posexplode("words").alias("offset", "word"))
    longest = Window.partitionBy("item_id", "m").orderBy(F.length("word").desc(), "word")
    anchor = word.withColumn("k", F.dense_rank().over(longest)).where("k <= cut + 3").select("item_id", "m", "lost", "cut", "word", "k").distinct()
    anchor = anchor.withColumn("n_anchors", F.count("*").over(Window.partitionBy("item_id", "m")))
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    at = texts.select("doc_id", F.xxhash64("text").alias("row"), _words("text").alias("all"))
    at = at.select("doc_id", "row", F.size("all").alias("size"), F.posexplode("all").alias("pos", "word"))
    lacking = F.when(F.col("size") < F.col("m"), F.col("cut")).otherwise(F.col("lost"))
    hit = at.join(_small(anchor), "word").withColumn("lacking", lacking).withColumn("need", F.greatest(F.col("n_anchors") - F.col("lacking"), F.lit(1)))
    # a window counts if it holds enough of the item's words, wherever they stand in it: first the
    # texts that hold enough at all, from one pass over all words; rows that repeat are one text
    text_key = ["doc_id", "row", "item_id", "m", "need", "lacking", "size"]
    enough = hit.groupBy(*text_key).agg(F.collect_set(F.struct("k", "pos")).alias("hits")).where(F.size(F.array_distinct("hits.k")) >= F.col("need"))
    # then the starts whose window has the word: of each word one range per hit, without overlap
    near = enough.select(*text_key, F.explode("hits").alias("h")).select(*text_key, "h.k", "h.pos")
    before = F.lag("pos").over(Window.partitionBy("doc_id", "row", "item_id", "k").orderBy("pos"))
    low = F.greatest(F.col("pos") - F.col("m") + 1, F.coalesce(before + 1, F.lit(0)), F.lit(0))
    high = F.least(F.col("pos"), F.greatest(F.col("size") - F.col("m"), F.lit(0)))
    ranges = near.withColumn("low", low).withColumn("high", high).where("low <= high")
    steps = ranges.select(*text_key, F.explode(F.array(F.struct(F.col("low").alias("start"), F.lit(1).alias("by")), F.struct((F.col("high") + 1).alias("start"), F.lit(-1).alias("by")))).alias("e")).select(*text_key, "e.*")
    steps = steps.groupBy(*text_key, "start").agg(F.sum("by").alias("by"))
    along = Window.partitionBy("doc_id", "row", "item_id").orderBy("start")
    held = steps.withColumn("found", F.sum("by").over(along)).withColumn("stop", F.lead("start").over(along)).where("found >= need")
    place = held.select("doc_id", "row", "item_id", "m", F.explode(F.sequence("start", F.col("stop") - 1)).alias("start"), "lacking")
    own = items.select("item_id", F.array_distinct("words").alias("own"))

    # 2. fingerprints of the windows there; the words of a text are made once and kept with the few texts that have places
    wanted = place.groupBy("doc_id", "row").agg(F.collect_set(F.struct("item_id", "m", "start", "lacking")).alias("windows"))
    split = written(texts.withColumn("row", F.xxhash64("text")).join(wanted, ["doc_id", "row"]).select("doc_id", "windows", _words("text").alias("all")), "decontaminate-texts")
    cut = F.transform("windows", lambda w: F.struct(w["item_id"].alias("item_id"), w["m"].alias("m"), w["start"].alias("start"), w["lacking"].alias("lacking"), F.slice("all", w["start"] + 1, w["m"]).alias("words")))
    window = split.select("doc_id", F.explode(cut).alias("w")).select("doc_id", "w.*").join(_small(own), "item_id")
    window = window.where(F.size(F.array_intersect("own", "words")) >= F.size("own") - F.col("lacking")).select("doc_id", "m", "start", "words").distinct()
    window = written(window.withColumn("wid", F.xxhash64("doc_id", "m", "start", "words")), "decontaminate-windows")
    prints = _fingerprint(window.select("wid", "m", F.explode("words").alias("word")), ["wid", "m"])
    item_prints = _fingerprint(word.select("item_id", "m", "word"), ["item_id", "m"])

    # 3. multi-index Hamming blocks
    flips = [0, *(1 << b for b in range(BITS))]
    index = item_prints.select("item_id", "m", F.col("print").alias("item_print"), F.explode(F.array(*[F.struct(F.lit(j).alias("block"), _block(j).bitwiseXOR(F.lit(x)).alias("value")) for j in range(BLOCKS) for x in flips])).alias("b")).select("item_id", "m", "item_print", "b.block", "b.value")
    probe = prints.select("wid", "m", "print", F.explode(F.array(*[F.struct(F.lit(j).alias("block"), _block(j).alias("value")) for j in range(BLOCKS)])).alias("b")).select("wid", "m", "print", "b.block", "b.value")
    near = probe.join(_small(index), ["m", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("wid", "item_id").distinct()

    # 4. exact weighted similarity
    told = window.join(near, "wid")
    mine = told.select("wid", "doc_id", "m", "start", "item_id", F.explode(_shingles("words")).alias("shingle"))
    mine = mine.groupBy("wid", "doc_id", "m", "start", "item_id", "shingle").agg(F.count("*").alias("k"))
    theirs = items.select("item_id", F.explode(_shingles("words")).alias("shingle")).groupBy("item_id", "shingle").agg(F.count("*").alias("ki"))
    total = theirs.groupBy("item_id").agg(F.sum("ki").alias("item_total"))
    both = mine.join(theirs, ["item_id", "shingle"], "left").groupBy("wid", "doc_id", "m", "start", "item_id").agg(F.sum("k").alias("own"), F.sum(F.when(F.col("ki").isNull(), 0).otherwise(F.least("k", "ki"))).alias("same"))
    scored = both.join(total, "item_id").withColumn("similarity", F.col("same") / (F.col("own") + F.col("item_total") - F.col("same"))).where(F.col("similarity") >= THRESHOLD)
    best = scored.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", -F.col("start"), "m")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.col2")).cast("long").alias("start"), F.col("best.m").cast("long").alias("n_words"), "best.similarity")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) contamination."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go, with all rows of their doc_id; rows without doc_id stay."""
    found = written(contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct(), "decontaminate-found")
    return docs.join(_small(found), "doc_id", "left_anti").select(*docs.columns)
