"""Conversation structure repair: prefix-doubling path ranking after a cost DP.

The rows of a conversation, in order, and the states of the role pattern
``(s?(ua)+)?`` span a graph: node (i, state) with i rows consumed, arcs for the
edits Keep, Rerole, Delete and Insert. A cost DP from the end gives each node its
distance, and only optimal arcs stay. They are ranked by the first letter of the
audit they begin, then by 2, 4, 8, ... letters: the rank of 2^(k+1) letters is
that of the pair (rank of 2^k letters, rank of the best arc where these end). The
last ranks choose each node's arc, and the least audit is read off through
doubled pointers. Equal audits can't differ otherwise: in each state an edit
letter leads to one state.

A conversation is cut into segments of at most ``SEGMENT`` rows in a range
shuffle of narrow rows (keys, fault flags, a SHA-256 of role and text), so one
that holds a third of all rows is many segments in many tasks. Where it has
several, each segment's 4 x 4 costs compose (min, +) to the distances behind it and
its state maps compose to the state it is entered in, both by doubling joins.
Copies are counted before the shuffle; texts move once, to the edits that keep
them. Only the digest of a repaired conversation, which the query asks for, reads
its rows in one task: a stream, as SHA-256 is one.

Rows are ordered by turn (null first), then role, then digest of the text, so
repeated rows and ties have one result. A null role or text is one space, so a
row without text is blank; null conv_ids are one conversation, null turns equal.
A role other than system, user, assistant is told by its first letter like them;
an empty one can't be kept. No rows after damage, or an empty table: see the
query. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.components import written

SEGMENT, PIECE = 1024, 1 << 16
SPACES = " \t\n\x0b\f\r"
#: costs; distances beyond FAR are unreachable
DELETE, CHANGE, FAR = 4, 3, 1 << 50
# states: nothing yet, after s, after u, after a; initials: s, u, a, any other
NONE, SYS, USER, ASSIST = range(4)
KEEP_TO = np.array([[SYS, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSIST, -1], [-1, USER, -1, -1]])
TURN_TO = np.array([USER, USER, ASSIST, USER])
#: cost of ending in each state, by inserts alone
CLOSE = np.array([0, 2 * CHANGE, CHANGE, 0])
FORCED, TRUNCATED = 4, 8
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
ROLE_OF = {USER: "user", ASSIST: "assistant"}
_SEGMENTS = "ck string, conv_id long, part long, nth long, codes binary, tk array<string>, h array<binary>"
_DONE = "ck string, conv_id long, seg long, step long, letter string, tk string, h binary, role string, audit string, cost long, illegal long, first int, last int"


# ---------------------------------------------------------------------------
# one batch of segments, in numpy
# ---------------------------------------------------------------------------


def distances(codes: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Distance of every node of segments ``codes[at[s]:at[s + 1]]`` to their ends, whose states cost ``ends[s]``.

    Node (i, q) of segment s is number ``4 * (at[s] + s + i) + q``.
    """
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    n, first, d = size[order], at[:-1][order], ends[order].astype(np.int64)
    dist = np.zeros((len(codes) + len(size), 4), np.int64)
    dist[first + order + n] = d
    active = np.searchsorted(-n, -np.arange(1, (n[0] if len(n) else 0) + 1), "right")
    for back, m in enumerate(active):
        i = n[:m] - 1 - back
        c = codes[first[:m] + i]
        after = d[:m]
        base = after + DELETE
        free, late = (c & FORCED) == 0, CHANGE * ((c & TRUNCATED) > 0)
        role = c & 3
        for q in range(4):
            turned = after[:, TURN_TO[q]] + CHANGE + late
            to = KEEP_TO[q][role]
            kept = np.where(to >= 0, after[np.arange(m), to] + late, FAR)
            base[:, q] = np.where(free, np.minimum(base[:, q], np.minimum(turned, kept)), base[:, q])
        user = np.minimum(base[:, USER], base[:, ASSIST] + CHANGE)
        base[:, ASSIST] = np.minimum(base[:, ASSIST], base[:, USER] + CHANGE)
        base[:, USER] = user
        for q in (NONE, SYS):
            base[:, q] = np.minimum(base[:, q], user + CHANGE)
        dist[first[:m] + order[:m] + i] = d[:m] = np.minimum(base, FAR)
    return dist.ravel()


def optimal_arcs(codes: np.ndarray, at: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tail, letter, head) of the arcs on cheapest paths, by tail; an end node has one arc of letter 0 to itself."""
    size = np.diff(at)
    seg = np.repeat(np.arange(len(size)), size)
    level = np.arange(len(codes)) + seg  # the node group of each row
    q = np.arange(4)
    tail = (4 * level[:, None] + q).ravel()
    code = np.repeat(codes, 4)
    state = np.tile(q, len(codes))
    late, free = CHANGE * ((code & TRUNCATED) > 0), (code & FORCED) == 0
    turn = TURN_TO[state]
    keep = KEEP_TO[state, code & 3]
    group = tail - state
    kinds = [
        (1, tail + 4, np.full(len(tail), DELETE), np.ones(len(tail), bool)),
        (2, group + turn, np.full(len(tail), CHANGE), np.ones(len(tail), bool)),
        (3, group + 4 + keep, late, free & (keep >= 0)),
        (4, group + 4 + turn, CHANGE + late, free),
    ]
    tails, letters, heads = [], [], []
    for letter, head, cost, there in kinds:
        on = there & (dist[tail] == cost + dist[head])
        tails.append(tail[on])
        heads.append(head[on])
        letters.append(np.full(int(on.sum()), letter))
    end = (4 * (at[1:] + np.arange(len(size)))[:, None] + q).ravel()
    tails.append(end)
    heads.append(end)
    letters.append(np.zeros(len(end), np.int64))
    tail, letter, head = np.concatenate(tails), np.concatenate(letters), np.concatenate(heads)
    order = np.argsort(tail, kind="stable")
    return tail[order], letter[order], head[order]


def ranked(tail: np.ndarray, letter: np.ndarray, head: np.ndarray) -> np.ndarray:
    """The arc of each node that begins its least audit, by ranks of 1, 2, 4, ... letters."""
    first = np.flatnonzero(np.append(True, tail[1:] != tail[:-1]))
    count = np.diff(np.append(first, len(tail)))
    rank, jump = letter, head
    while True:
        least = np.repeat(np.minimum.reduceat(rank, first), count)
        where = np.where(rank == least, np.arange(len(rank)), len(rank))
        best = np.minimum.reduceat(where, first)
        if (letter[first[jump]] == 0).all():  # every audit has ended
            return best
        then = best[jump]
        _, rank_next = np.unique(rank * (len(rank) + 5) + rank[then], return_inverse=True)
        rank, jump = rank_next, jump[then]


def paths(codes: np.ndarray, at: np.ndarray, ends: np.ndarray, entries: np.ndarray):
    """Least audits of segments entered in the given states: (segment, row, letter, state after) of each edit, and exit states."""
    tail, letter, head = optimal_arcs(codes, at, distances(codes, at, ends))
    best = ranked(tail, letter, head)
    up = [head[best]]
    steps = (letter[best] > 0).astype(np.int64)
    while True:  # doubled pointers, and the letters they pass
        now = up[-1]
        further = steps + steps[now]
        if (further == steps).all():
            break
        steps = further
        up.append(now[now])
    start = 4 * (at[:-1] + np.arange(len(at) - 1)) + entries
    size = steps[start]
    seg = np.repeat(np.arange(len(size)), size)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    node, leave = start[seg], start.copy()
    for k, to in enumerate(up):
        odd = (step >> k) & 1 == 1
        node[odd] = to[node[odd]]
        odd = (size >> k) & 1 == 1
        leave[odd] = to[leave[odd]]
    return seg, step, node // 4 - at[seg] - seg, letter[best[node]], up[0][node] % 4, leave % 4, size


# ---------------------------------------------------------------------------
# the same inside Spark tasks
# ---------------------------------------------------------------------------


def _cut(batches):
    """Sorted narrow rows into segments; an open conversation waits for the rows that follow."""
    waiting, nth = None, 0

    def made(table, last):
        nonlocal nth, waiting
        ids = table["ck"].combine_chunks().dictionary_encode().indices.to_numpy()
        new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        runs = np.append(new, len(ids))
        cuts = np.concatenate([np.arange(a, b, SEGMENT) for a, b in zip(runs[:-1], runs[1:], strict=True)])
        stop = len(ids) if last or len(ids) - cuts[-1] >= SEGMENT else cuts[-1]
        cuts = cuts[cuts < stop]
        waiting = table.slice(stop) if stop < len(ids) else None
        if not len(cuts):
            return None
        bounds = pa.array(np.append(cuts, stop).astype(np.int32))
        take = table.take(pa.array(cuts))
        codes = table["code"].to_numpy().astype(np.uint8)[:stop].tobytes()
        out = {
            "ck": take["ck"], "conv_id": take["conv_id"], "part": take["part"], "nth": pa.array(nth + np.arange(len(cuts))),
            "codes": pa.Array.from_buffers(pa.binary(), len(cuts), [None, bounds.buffers()[1], pa.py_buffer(codes)]),
            "tk": pa.ListArray.from_arrays(bounds, table["tk"].combine_chunks().slice(0, stop)), "h": pa.ListArray.from_arrays(bounds, table["h"].combine_chunks().slice(0, stop)),
        }
        nth += len(cuts)
        return pa.table(out)

    for batch in batches:
        upto = np.cumsum(batch.column("n").to_numpy())
        for a in range(0, int(upto[-1]) if len(upto) else 0, PIECE):
            place = np.arange(a, min(a + PIECE, upto[-1]))
            group = np.searchsorted(upto, place, "right")
            rows = pa.Table.from_batches([batch]).take(pa.array(group))
            # of a row's copies the first alone is no duplicate, if it is none itself
            copy = np.append(place[0] != (upto[group[0]] - batch.column("n")[int(group[0])].as_py()), group[1:] == group[:-1])
            code = rows["code"].to_numpy() | np.where(copy, FORCED, 0)
            rows = rows.set_column(rows.schema.get_field_index("code"), "code", pa.array(code.astype(np.int32))).drop_columns(["n"])
            done = made(rows if waiting is None else pa.concat_tables([waiting, rows]), False)
            if done is not None:
                yield from done.to_batches()
    if waiting is not None:
        yield from made(waiting, True).to_batches()


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, np.uint8) for x in column.to_pylist()]
    return np.concatenate([np.zeros(0, np.uint8), *parts]).astype(np.int64), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _costs(batches):
    """(min, +) costs of each segment from state to state, row by row."""
    for batch in batches:
        codes, at = _flat(batch.column("codes"))
        start = at[:-1] + np.arange(len(at) - 1)
        columns = []
        for q in range(4):
            ends = np.full((len(start), 4), FAR)
            ends[:, q] = 0
            columns.append(distances(codes, at, ends).reshape(-1, 4)[start])
        m = np.stack(columns, 2).reshape(len(start), 16)
        yield pa.record_batch({"ck": batch.column("ck"), "j": batch.column("j"), "value": pa.array(m.tolist(), pa.list_(pa.int64()))})


def _maps(batches):
    """Exit state of each segment by entry state, given the distances behind it."""
    for batch in batches:
        codes, at = _flat(batch.column("codes"))
        ends = np.array(batch.column("ends").to_pylist(), np.int64).reshape(-1, 4)
        out = [paths(codes, at, ends, np.full(len(ends), q))[5] for q in range(4)]
        yield pa.record_batch({"ck": batch.column("ck"), "j": batch.column("j"), "value": pa.array(np.stack(out, 1).tolist(), pa.list_(pa.int64()))})


_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def _edit(batches):
    """Of each segment a summary (step -1) and its edits but the deletions."""
    for batch in batches:
        codes, at = _flat(batch.column("codes"))
        ends = np.array(batch.column("ends").to_pylist(), np.int64).reshape(-1, 4)
        n_seg = len(ends)
        if not n_seg:
            continue
        seg, step, row, letter, after, leave, size = paths(codes, at, ends, batch.column("entry").to_numpy().astype(np.int64))
        closing = np.where(batch.column("final").to_numpy(zero_copy_only=False), CLOSE[leave] // CHANGE, 0)
        upto = np.concatenate([[0], np.cumsum(size)])
        text = LETTERS[letter].tobytes().decode("ascii")
        audit = [text[a:b] + "I" * k for a, b, k in zip(upto[:-1], upto[1:], closing.tolist(), strict=True)]
        code = codes[at[seg] + np.minimum(row, np.diff(at)[seg] - 1)]
        late = ((code & TRUNCATED) > 0) & (letter >= 3)
        cost = np.bincount(seg, np.array([0, DELETE, CHANGE, 0, CHANGE])[letter] + CHANGE * late, n_seg).astype(np.int64) + CHANGE * closing
        role = codes & 3
        odd = ~_LEGAL[role[:-1], role[1:]]
        odd[at[1:-1] - 1] = False  # between segments
        owner = np.repeat(np.arange(n_seg), np.diff(at))
        illegal = np.bincount(owner[:-1][odd], minlength=n_seg)
        ck, conv, number = batch.column("ck"), batch.column("conv_id"), batch.column("seg")
        no = lambda kind, m: pa.nulls(m, kind)
        yield pa.record_batch({
            "ck": ck, "conv_id": conv, "seg": number, "step": pa.array(np.full(n_seg, -1)), "letter": no(pa.string(), n_seg), "tk": no(pa.string(), n_seg), "h": no(pa.binary(), n_seg), "role": no(pa.string(), n_seg),
            "audit": pa.array(audit), "cost": pa.array(cost), "illegal": pa.array(illegal), "first": pa.array(role[at[:-1]].astype(np.int32)), "last": pa.array(role[at[1:] - 1].astype(np.int32)),
        })
        # closing inserts: from s a user, then from u an assistant
        c_seg = np.repeat(np.arange(n_seg), closing)
        c_nth = np.arange(len(c_seg)) - np.repeat(np.cumsum(closing) - closing, closing)
        c_state = np.where(c_nth + 1 == closing[c_seg], ASSIST, USER)
        kept = letter > 1
        seg, step, row, letter, after = (np.concatenate([x[kept], y]) for x, y in ((seg, c_seg), (step, size[c_seg] + c_nth), (row, c_seg * 0), (letter, c_seg * 0 + 2), (after, c_state)))
        of_row = pa.array(at[seg] + row, mask=letter == 2)
        m = len(seg)
        given = pa.array([ROLE_OF.get(int(s)) if e != 3 else None for s, e in zip(after, letter, strict=True)], pa.string())
        take = pa.array(seg)
        yield pa.record_batch({
            "ck": ck.take(take), "conv_id": conv.take(take), "seg": number.take(take), "step": pa.array(step), "letter": pa.array([chr(LETTERS[x]) for x in letter], pa.string()),
            "tk": batch.column("tk").flatten().take(of_row), "h": batch.column("h").flatten().take(of_row), "role": given,
            "audit": no(pa.string(), m), "cost": no(pa.int64(), m), "illegal": no(pa.int64(), m), "first": no(pa.int32(), m), "last": no(pa.int32(), m),
        })


def _digests(batches):
    """SHA-256 of each conversation's rows, which come in order, read as a stream."""
    key, state, done = None, None, []
    for batch in batches:
        for ck, line in zip(batch.column("ck").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if ck != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = ck, hashlib.sha256()
                state.update(line.encode("utf-8", "surrogatepass"))
            else:
                state.update(b"\n" + line.encode("utf-8", "surrogatepass"))
        yield pa.record_batch({"ck": pa.array([k for k, _ in done], pa.string()), "sha": pa.array([s for _, s in done], pa.string())})
        done = []
    if state is not None:
        yield pa.record_batch({"ck": pa.array([key]), "sha": pa.array([state.hexdigest()])})


# ---------------------------------------------------------------------------
# the plan
# ---------------------------------------------------------------------------


def _keyed(conversations: DataFrame) -> DataFrame:
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("ck"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")).alias("tk"),
        role.alias("role"),
        text.alias("text"),
    )
    return rows.withColumn("h", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _narrow(rows: DataFrame) -> DataFrame:
    """One narrow row for each distinct row, with its number of copies and its faults."""
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    flags = rows.select("ck", "conv_id", "turn", "tk", "role", "h", code.alias("code"), (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("late"))
    groups = flags.groupBy(*flags.columns).agg(F.count("*").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"))
    seen = groups.groupBy("ck", "h").agg(F.min(order).alias("first"), F.count("*").alias("turns")).where("turns > 1").drop("turns")
    return groups.join(seen, ["ck", "h"], "left").withColumn("again", F.coalesce(order > F.col("first"), F.lit(False))).drop("first")


def _doubled(table: DataFrame, combine, ahead: int) -> DataFrame:
    """(ck, j, value): values of j and all segments behind it (ahead 1) or before it (-1), in log2 rounds of joins."""
    longest, reach = table.agg(F.max("j")).first()[0], 1
    while longest is not None and reach <= longest:
        other = table.select("ck", (F.col("j") - ahead * reach).alias("j"), F.col("value").alias("other"))
        both = table.join(other, ["ck", "j"], "left")
        table = written(both.select("ck", "j", F.when(F.col("other").isNull(), F.col("value")).otherwise(combine).alias("value")), "repair-doubled")
        reach *= 2
    return table


def _then_costs() -> Column:
    """Costs of two segments in a row."""
    return F.expr("transform(sequence(0L, 15L), x -> array_min(transform(sequence(0L, 3L), k -> value[int(x div 4 * 4 + k)] + other[int(k * 4 + x % 4)])))")


def _then_states() -> Column:
    """States behind two segments in a row, the other one first."""
    return F.expr("transform(other, s -> value[int(s)])")


def edits(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: narrow rows with faults, and the summaries and edits of all segments; and the rows by key."""
    rows = _keyed(conversations)
    narrow = written(_narrow(rows), "repair-narrow")
    spark = conversations.sparkSession
    code = F.col("code") + F.when(F.col("blank") | F.col("again"), FORCED).otherwise(0) + F.when(F.col("late"), TRUNCATED).otherwise(0)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = ["ck", "turn", "role", "h"]
    ordered = narrow.repartitionByRange(tasks, *sort).sortWithinPartitions(*sort)
    ordered = ordered.select("ck", "conv_id", F.spark_partition_id().cast("long").alias("part"), "tk", "h", code.cast("int").alias("code"), "n")
    segments = written(ordered.mapInArrow(_cut, _SEGMENTS), "repair-segments").withColumn("seg", F.col("part") * (1 << 32) + F.col("nth"))

    # conversations of several segments: number these; a row per conversation and task is enough for the offsets
    per_task = segments.groupBy("ck", "part").agg(F.count("*").alias("here"), F.min("nth").alias("low"))
    several = per_task.groupBy("ck").agg(F.sum("here").alias("of")).where("of > 1")
    before = F.sum("here").over(Window.partitionBy("ck").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.join(several, "ck").select("ck", "part", "low", "of", F.coalesce(before, F.lit(0)).alias("before"))
    parts = written(offsets, "repair-offsets")
    long = segments.join(parts, ["ck", "part"]).withColumn("j", (F.col("before") + F.col("nth") - F.col("low")).cast("long"))
    close = F.array(*[F.lit(int(c)).cast("long") for c in CLOSE])
    common = ["ck", "conv_id", "seg", "codes", "tk", "h"]
    single = segments.join(parts.select("ck").distinct(), "ck", "left_anti").select(*common, close.alias("ends"), F.lit(0).cast("long").alias("entry"), F.lit(True).alias("final"))
    ready = single
    if not parts.isEmpty():
        long = written(long, "repair-long")
        chains = _doubled(written(long.select("ck", "j", "codes").mapInArrow(_costs, "ck string, j long, value array<long>"), "repair-costs"), _then_costs(), 1)
        sums = F.expr(f"transform(sequence(0L, 3L), q -> array_min(transform(sequence(0L, 3L), k -> value[int(q * 4 + k)] + array({', '.join(f'{c}L' for c in CLOSE)})[int(k)])))")
        behind = chains.where("j > 0").select("ck", (F.col("j") - 1).alias("j"), sums.alias("ends"))
        ended = written(long.join(behind, ["ck", "j"], "left").withColumn("ends", F.coalesce("ends", close)), "repair-ends")
        states = _doubled(written(ended.select("ck", "j", "codes", "ends").mapInArrow(_maps, "ck string, j long, value array<long>"), "repair-maps"), _then_states(), -1)
        enter = states.select("ck", (F.col("j") + 1).alias("j"), F.col("value")[NONE].alias("entry"))
        entered = ended.join(enter, ["ck", "j"], "left").select(*common, "ends", F.coalesce("entry", F.lit(0)).alias("entry"), (F.col("j") + 1 == F.col("of")).alias("final"))
        ready = single.unionByName(entered)
    return narrow, written(ready.mapInArrow(_edit, _DONE), "repair-edits"), rows


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows, and one row per conversation.

    Rows: ck, conv_id, seg, step (their order), letter (K, R or I), role, text.
    Conversations: ck, conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit. ``ck`` stands for conv_id, null too.
    """
    narrow, done, rows = edits(conversations)
    texts = rows.select("ck", "tk", "h", "role", "text").dropDuplicates(["ck", "tk", "h"])
    changes = done.where("step >= 0").select("ck", "conv_id", "seg", "step", "letter", "tk", "h", F.col("role").alias("given"))
    kept = changes.where("letter <> 'I'").join(texts, ["ck", "tk", "h"])
    repaired = kept.select("ck", "conv_id", "seg", "step", "letter", F.coalesce("given", "role").alias("role"), "text")
    repaired = repaired.unionByName(changes.where("letter = 'I'").select("ck", "conv_id", "seg", "step", "letter", F.col("given").alias("role"), F.lit("").alias("text")))

    turns = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = narrow.groupBy("ck", "conv_id").agg(F.coalesce(turns, F.lit(0)).alias("gaps"))
    live, n = ~F.col("blank"), F.col("n")
    faults = narrow.groupBy("ck").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(live, n - F.when(F.col("again"), 0).otherwise(1)).otherwise(0)).alias("duplicate"),
        F.sum(F.when(live & ~F.col("again") & F.col("late"), 1).otherwise(0)).cast("long").alias("truncated"),
    )
    inside = F.array_sort(F.collect_list(F.struct("seg", "audit", "first", "last")))
    audits = done.where("step < 0").groupBy("ck").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("inside"), inside.alias("s"))
    between = F.expr("size(filter(transform(sequence(1, size(s)), i -> if(i < size(s), concat(s[i - 1].last, s[i].first), '01')), p -> p not in ('01', '12', '21')))")
    audits = audits.select("ck", "cost", (F.col("inside") + between).alias("illegal"), F.array_join(F.transform("s", lambda x: x["audit"]), "").alias("audit"))
    summary = gaps.join(faults, "ck").join(audits, "ck")
    return repaired, summary.select("ck", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the contract's faults: by CRC-32 of ``conv_id:turn`` modulo 20 dropped, emptied, unpunctuated, repeated or given to the user."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown[3], "[.!?]", "")).otherwise(shown[3])
    rows = conversations.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(shown[2]).alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.withColumn("again", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).select("conv_id", "turn", "role", "text")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, the audit of its cheapest repair and the digest of the repaired rows.

    A conversation that has lost all rows has zeros, an empty audit and the digest of the empty string.
    """
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return _report(given, damaged(given))


def _report(given: DataFrame, rows: DataFrame) -> DataFrame:
    repaired, summary = repair(rows)
    lines = repaired.select("ck", "seg", "step", F.concat("role", F.lit(":"), "text").alias("line")).repartition("ck").sortWithinPartitions("ck", "seg", "step")
    hashes = lines.select("ck", "line").mapInArrow(_digests, "ck string, sha string")
    every = _keyed(given).select("ck", "conv_id").distinct()
    out = every.join(summary.drop("conv_id"), "ck", "left").join(hashes, "ck", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
