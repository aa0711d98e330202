"""Conversation structure repair: cheapest edits that make a log legal, by rank-convergence Viterbi.

A legal conversation is empty, or an optional system turn and then pairs of a user and an assistant
turn. Rows may be kept (cost 0), given the role user or assistant (1) or deleted (2, required for
blank and repeated rows); an empty turn may be inserted anywhere (5), and a truncated row that is not
deleted adds 5. Backward costs, one for each of four states of a legal conversation, say how cheaply
it can go on from a row; the audit follows them from the front and takes the least letter that keeps
to the cheapest way.

Conversations of any length are worked on in parallel. Turns are dealt out by range and cut into
chunks of at most ``CHUNK_ROWS`` rows and about ``CHUNK_CHARS`` characters; a conversation may lie in
many chunks and hold most of all rows. Cost vectors that differ only by a constant lead to the same
edits, so a vector counts as its differences, of which few can occur (``VECTORS``). A chunk does not
know the vector behind it: it starts from all of them as speculation, and they soon run together
(rank convergence), which settles the chunk whatever follows. Where they have not, fix-up passes take
on the vectors of the chunks behind, twice as far with every pass, until each is settled. The trace
goes the other way: each chunk finds its state at the end for every state at its start, and passes of
the same kind settle the states. A last pass over the chunks, each with its vector behind and its
state in front, edits the rows. Conversations in one chunk, almost all, go straight to that pass.

The digest of a repaired conversation is a single hash, so it is one task's work to run over it; the
chunks stream through that task, sorted on disk, and only a chunk is held.

Results for odd rows: null roles and texts are one space, which makes them an unknown role and a blank
row. A null conv_id is a conversation of its own. Rows go by turn (null first), then role, then a
digest of role and text; a repeated row is a duplicate like any other. A role counts by its first
letter; one that is empty or not s, u or a can only be renamed or deleted. Very long texts are taken
whole. Conversations without rows cost nothing and have an empty audit. Other columns are ignored. An
empty table has no conversations.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import parts, small_batches, table, written

CHUNK_ROWS, CHUNK_CHARS = 4096, 4_000_000
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"

#: States of a legal conversation: nothing yet, after system, after user, after assistant.
STATES = (0, 1, 2, 3)
#: The state after an inserted or renamed turn, and the role that leads to a state.
TURN, ROLE = (2, 2, 3, 2), (None, None, "user", "assistant")
_KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEVER = 1 << 20

Vector = tuple[int, ...]
#: A row as the costs see it: its role's letter ("" for others), truncated or not; or None if it has to go.
Row = tuple[str, bool] | None
ROWS: tuple[Row, ...] = (None, *((letter, cut) for letter in ("s", "u", "a", "") for cut in (False, True)))


def _with_inserts(costs: Sequence[int]) -> Vector:
    user, assistant = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + user), min(costs[1], INSERT + user), user, assistant


#: What is left to pay behind the last row.
END: Vector = _with_inserts((0, _NEVER, _NEVER, 0))


def _ways(behind: Vector, row: Row, state: int) -> list[tuple[int, str, int, int]]:
    """(cost with what follows, edit, next state, cost of the edit) of all a row allows."""
    found = [(DELETE + behind[state], "D", state, DELETE)]
    if row is not None:
        letter, more = row[0], TRUNCATED if row[1] else 0
        if (state, letter) in _KEPT:
            after = _KEPT[state, letter]
            found.append((KEEP + more + behind[after], "K", after, KEEP + more))
        found.append((RENAME + more + behind[TURN[state]], "R", TURN[state], RENAME + more))
    return found


def _before(behind: Vector, row: Row) -> Vector:
    return _with_inserts([min(w[0] for w in _ways(behind, row, s)) for s in STATES])


@functools.cache
def back(behind: Vector, row: Row) -> Vector:
    """The vector in front of a row, as differences, from that behind it."""
    costs = _before(behind, row)
    return tuple(c - min(costs) for c in costs)


@functools.cache
def edits(behind: Vector, row: Row, state: int) -> tuple[str, int, int]:
    """(letters, next state, cost) of the least audit at a row: inserts in front of it and its own edit."""
    costs, letters, paid = _before(behind, row), "", 0
    while True:
        ways = {edit: (after, cost) for total, edit, after, cost in _ways(behind, row, state) if total == costs[state]}
        if "D" not in ways and INSERT + costs[TURN[state]] == costs[state]:
            letters, paid, state = letters + "I", paid + INSERT, TURN[state]
            continue
        edit = min(ways)
        return letters + edit, ways[edit][0], paid + ways[edit][1]


def _reachable() -> tuple[Vector, ...]:
    found = [END]
    for vector in found:  # grows while it is read
        found += [v for v in dict.fromkeys(back(vector, row) for row in ROWS) if v not in found]
    return tuple(found)


#: Every vector that can occur, as differences; the first is that behind the last row.
VECTORS = _reachable()
_PLACE = {v: i for i, v in enumerate(VECTORS)}


# --- turns to chunks


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated or given a wrong role by a hash of their key."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    given = conversations.select(
        "conv_id", "turn", kind.alias("kind"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return given.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null")).alias("key")


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS, ranges: int | None = None) -> DataFrame:
    """(key, conv_id, chunk, turns, roles, texts, digests, again): runs of a conversation's rows, in the order of ``chunk``.

    ``again`` marks rows equal to an earlier one of their chunk.
    """
    small_batches(rows.sparkSession)
    kind = dict(rows.dtypes)["conv_id"]
    schema = (
        f"key string, conv_id {kind}, chunk bigint, turns array<bigint>, roles array<string>, texts array<string>, "
        "digests array<string>, again array<boolean>"
    )
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    # the last column parts rows that are equal in all others
    given = rows.select(
        _key(), "conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), digest.alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "turn", "role", "digest", "row"]
    dealt = given.repartitionByRange(ranges or parts(rows.sparkSession), *order).sortWithinPartitions(*order).drop("row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        ready: list[tuple] = []
        size = ready_size = 0
        types: list[pa.DataType] = []

        def close() -> None:
            nonlocal number, size, ready_size
            if held:
                seen: set[str] = set()
                again = [r[5] in seen or seen.add(r[5]) is not None for r in held]
                ready.append((held[0][0], held[0][1], number, *([r[i] for r in held] for i in range(2, 6)), again))
                number += 1
                ready_size += size
                held.clear()
                size = 0

        def shown() -> pa.RecordBatch:
            nonlocal ready_size
            columns = [pa.array(c, k) for c, k in zip(zip(*ready, strict=True), types, strict=True)]
            ready.clear()
            ready_size = 0
            return pa.record_batch(columns, ["key", "conv_id", "chunk", "turns", "roles", "texts", "digests", "again"])

        for batch in batches:
            strings = pa.list_(pa.string())
            types = [pa.string(), batch.schema.field("conv_id").type, pa.int64(), pa.list_(pa.int64()), strings, strings, strings, pa.list_(pa.bool_())]
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "turn", "role", "text", "digest")), strict=True):
                if held and (held[-1][0] != row[0] or len(held) >= chunk_rows or size >= chunk_chars):
                    close()
                    if ready_size >= chunk_chars or len(ready) >= 256:
                        yield shown()
                held.append(row)
                size += len(row[4])
        close()
        if ready:
            yield shown()

    return dealt.mapInArrow(cut, schema)


def linked(cut: DataFrame) -> DataFrame:
    """(key, chunk, place, n_chunks) of the conversations that lie in several chunks of a stored table."""
    keys = cut.groupBy("key").agg(F.count(F.lit(1)).alias("n_chunks")).where("n_chunks > 1")
    split = cut.select("key", "chunk").join(keys, "key")
    return split.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("chunk")).cast("bigint"))


def with_repeats(cut: DataFrame, split: DataFrame) -> DataFrame:
    """The chunks of ``split`` with ``again`` also for rows equal to one of an earlier chunk."""
    mine = cut.join(split, ["key", "chunk"])
    rows = mine.select("key", "chunk", F.posexplode(F.arrays_zip("digests", "again")).alias("at", "row")).where("not row.again")
    rows = rows.select("key", "chunk", "at", F.col("row.digests").alias("digest"))
    first = rows.groupBy("key", "digest").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    later = rows.join(first.hint("merge"), ["key", "digest"]).where("chunk > first")
    later = later.groupBy("key", "chunk").agg(F.collect_set("at").alias("later"))  # no more than a chunk's rows
    found = mine.join(later.hint("merge"), ["key", "chunk"], "left")
    at = F.coalesce("later", F.array().cast("array<int>"))
    again = F.transform("again", lambda x, i: x | F.array_contains(at, i))
    return found.withColumn("again", F.when(F.size(at) == 0, F.col("again")).otherwise(again)).drop("later")


def row_of(role: str, text: str, again: bool) -> Row:
    filled = text.rstrip(BLANKS)
    if again or not filled:
        return None
    return (role[0] if role[:1] in ("s", "u", "a") else "", filled[-1] not in ".!?")


# --- passes over chunks


def _rows(batch: pa.RecordBatch) -> Iterator[list[Row]]:
    for roles, texts, again in zip(*(batch.column(c).to_pylist() for c in ("roles", "texts", "again")), strict=True):
        yield [row_of(*r) for r in zip(roles, texts, again, strict=True)]


def vectors_in_front(split: DataFrame) -> DataFrame:
    """(key, place, n_chunks, way): for each of ``VECTORS`` behind a chunk, the place of that in front of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows in _rows(batch):
                now: dict[Vector, list[int]] = {v: [i] for i, v in enumerate(VECTORS)}
                for row in reversed(rows):
                    ahead: dict[Vector, list[int]] = {}
                    for vector, starts in now.items():
                        ahead.setdefault(back(vector, row), []).extend(starts)
                    now = ahead
                way = [0] * len(VECTORS)
                for vector, starts in now.items():
                    for i in starts:
                        way[i] = _PLACE[vector]
                found.append(way)
            yield pa.record_batch([*(batch.column(c) for c in ("key", "place", "n_chunks")), pa.array(found, pa.list_(pa.int32()))], ["key", "place", "n_chunks", "way"])

    return split.select("key", "place", "n_chunks", "roles", "texts", "again").mapInArrow(run, "key string, place bigint, n_chunks bigint, way array<int>")


def states_behind(split: DataFrame) -> DataFrame:
    """(key, place, n_chunks, way): for each of ``STATES`` in front of a chunk, that behind it, given its ``vector`` behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for rows, end in zip(_rows(batch), batch.column("vector").to_pylist(), strict=True):
                behind = _behind(rows, VECTORS[end])
                way = list(STATES)
                for row, vector in zip(rows, behind, strict=True):
                    way = [edits(vector, row, s)[1] for s in way]
                found.append(way)
            yield pa.record_batch([*(batch.column(c) for c in ("key", "place", "n_chunks")), pa.array(found, pa.list_(pa.int32()))], ["key", "place", "n_chunks", "way"])

    given = split.select("key", "place", "n_chunks", "roles", "texts", "again", "vector")
    return given.mapInArrow(run, "key string, place bigint, n_chunks bigint, way array<int>")


def _behind(rows: list[Row], end: Vector) -> list[Vector]:
    """The vector behind each row."""
    found = [end]
    for row in reversed(rows[1:]):
        found.append(back(found[-1], row))
    return found[::-1]


def settled(ways: DataFrame, step: int, start: int) -> DataFrame:
    """(key, place, out): what leaves every chunk, where a chunk turns what leaves the one ``step`` places on into ``way[that]``.

    ``start`` enters the first chunk on that way. A chunk whose way is constant is settled at once;
    the others take on the way of the chunk their own begins at, until that one is settled.
    """
    first = F.col("place") == (F.lit(1) if step < 0 else F.col("n_chunks"))
    found = F.when(first, F.col("way")[start]).alias("found")
    now = written(ways.select("key", "place", "way", (F.col("place") + step).alias("source"), found), "ways")
    constant = F.when(F.array_min("way") == F.array_max("way"), F.col("way")[0])
    while True:
        # a column of its own, read from the table: a transformed array must not be worked out several times in one row
        known = now.withColumn("out", F.coalesce("found", constant))
        if known.where("out is null").isEmpty():
            return known.select("key", "place", "out")
        other = known.select("key", F.col("place").alias("source"), F.col("way").alias("w"), F.col("source").alias("s"), F.col("out").alias("o"))
        open_ways = known.where("out is null").select("key", "source", "place", "way").join(other.hint("merge"), ["key", "source"])
        longer = F.transform("w", lambda x: F.element_at("way", x + 1))
        moved = open_ways.select("key", "place", longer.alias("way"), F.col("s").alias("source"), F.element_at("way", F.col("o") + 1).alias("found"))
        kept = known.where("out is not null").select("key", "place", "way", "source", F.col("out").alias("found"))
        now = written(kept.union(moved), "ways")


def _neighbour(split: DataFrame, out: DataFrame, step: int, start: int, name: str) -> DataFrame:
    """``split`` with what leaves the chunk ``step`` places on, ``start`` where there is none."""
    near = out.select("key", (F.col("place") - step).alias("place"), F.col("out").alias(name))
    return split.join(near.hint("merge"), ["key", "place"], "left").withColumn(name, F.coalesce(name, F.lit(start)))


def edited(placed: DataFrame) -> DataFrame:
    """Chunks with ``vector`` behind and ``state`` in front, repaired: messages, audit, cost and the faults found."""
    kind = dict(placed.dtypes)["conv_id"]
    counts = ("blank", "duplicate", "truncated", "illegal", "cost", "gained")
    schema = (
        f"key string, conv_id {kind}, place bigint, n_chunks bigint, messages array<struct<role:string,text:string>>, audit string, "
        + ", ".join(f"{c} bigint" for c in counts) + ", first_role string, last_role string, first_turn bigint, last_turn bigint, least_turn bigint"
    )
    message = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            names = ("turns", "roles", "texts", "again", "vector", "state", "place", "n_chunks")
            for turns, roles, texts, again, vector, state, place, n in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                found.append(_edited(turns, roles, texts, again, VECTORS[vector], state, place == n))
            columns = list(zip(*found, strict=True))
            types = [message, pa.string(), *[pa.int64()] * 6, *[pa.string()] * 2, *[pa.int64()] * 3]
            arrays = [pa.array(c, k) for c, k in zip(columns, types, strict=True)]
            keys = ["key", "conv_id", "place", "n_chunks"]
            rest = ["messages", "audit", *counts, "first_role", "last_role", "first_turn", "last_turn", "least_turn"]
            yield pa.record_batch([*(batch.column(c) for c in keys), *arrays], [*keys, *rest])

    given = placed.select("key", "conv_id", "place", "n_chunks", "turns", "roles", "texts", "again", "vector", "state")
    return given.mapInArrow(run, schema)


def _edited(turns: list, roles: list, texts: list, again: list, end: Vector, state: int, last: bool) -> tuple:
    rows = [row_of(*r) for r in zip(roles, texts, again, strict=True)]
    messages, audit, cost = [], [], 0
    for row, vector, role, text in zip(rows, _behind(rows, end), roles, texts, strict=True):
        letters, _, paid = edits(vector, row, state)
        audit.append(letters)
        cost += paid
        for letter in letters:
            if letter == "K":
                state = _KEPT[state, row[0]]
                messages.append((role, text))
            elif letter != "D":
                state = TURN[state]
                messages.append((ROLE[state], "" if letter == "I" else text))
    while last and state in (1, 2):
        state = TURN[state]
        messages.append((ROLE[state], ""))
        audit.append("I")
        cost += INSERT
    blank = sum(not t.rstrip(BLANKS) for t in texts)
    duplicate = sum(row is None for row in rows) - blank
    first = [r[:1] for r in roles]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
    known = [t for t in turns if t is not None]
    truncated = sum(row is not None and row[1] for row in rows)
    numbers = (blank, duplicate, truncated, illegal, cost, len(set(known)))
    shown = [{"role": r, "text": t} for r, t in messages]
    return shown, "".join(audit), *numbers, first[0], first[-1], turns[0], turns[-1], min(known, default=None)


# --- whole conversations


def repaired(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_chars: int = CHUNK_CHARS, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Repaired chunks of (conv_id, turn, role, text): those of whole conversations, and those of split ones in a stored table.

    Both have a conversation's ``key``, ``place`` among its ``n_chunks``, the repaired ``messages`` and their ``audit``.
    """
    cut = written(chunks(rows, chunk_rows, chunk_chars, ranges), "chunks")
    places = written(linked(cut), "places")
    whole = cut.join(places.select("key").distinct().hint("merge"), "key", "left_anti")
    whole = whole.withColumns({"place": F.lit(1).cast("bigint"), "n_chunks": F.lit(1).cast("bigint"), "vector": F.lit(0), "state": F.lit(0)})
    if places.isEmpty():
        return edited(whole), edited(whole.where("false"))
    split = written(with_repeats(cut, places), "split")
    split = _neighbour(split, settled(vectors_in_front(split), 1, 0), 1, 0, "vector")
    split = written(split, "vectors")
    split = _neighbour(split, settled(states_behind(split), -1, 0), -1, 0, "state")
    return edited(whole), written(edited(split), "edited")


def _body(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")


def digests(split: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of split conversations: their chunks stream through one hash in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hashed, empty = None, hashlib.sha256(), True
        for batch in batches:
            done = []
            for name, body in zip(batch.column("key").to_pylist(), batch.column("body").to_pylist(), strict=True):
                if name != key:
                    if key is not None:
                        done.append((key, hashed.hexdigest()))
                    key, hashed, empty = name, hashlib.sha256(), True
                if body is not None:
                    hashed.update((b"" if empty else b"\n") + body.encode("utf-8", "surrogatepass"))
                    empty = False
            if done:
                yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*done, strict=True)], ["key", "repaired_sha256"])
        if key is not None:
            yield pa.record_batch([pa.array([key]), pa.array([hashed.hexdigest()])], ["key", "repaired_sha256"])

    body = F.when(F.size("messages") > 0, _body(F.col("messages"))).alias("body")
    dealt = split.select("key", "place", body).repartition(parts(split.sparkSession), "key").sortWithinPartitions("key", "place")
    return dealt.mapInArrow(run, "key string, repaired_sha256 string")


_SHOWN = ("blank", "duplicate", "truncated", "illegal", "cost")


def summaries(whole: DataFrame, split: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation with rows."""
    span = F.coalesce(F.col("last_turn") - F.col("least_turn") + 1, F.lit(0).cast("bigint"))
    one = whole.select(
        "key", (span - F.col("gained")).alias("gaps"), *_SHOWN, "audit", F.sha2(_body(F.col("messages")).cast("binary"), 256).alias("repaired_sha256")
    )
    near = Window.partitionBy("key").orderBy("place")
    before = F.lag("last_role").over(near)
    joint = F.when(before.isNotNull() & ~F.concat(before, "first_role").isin("su", "ua", "au"), 1).otherwise(0)
    # turns are in order, so a turn can only be shared with the chunk before
    shared = F.when(F.lag("last_turn").over(near) == F.col("least_turn"), 1).otherwise(0)
    facts = split.select("key", "place", *_SHOWN, "gained", "audit", "last_turn", "least_turn", joint.alias("joint"), shared.alias("shared"))
    whole_audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "")
    many = facts.groupBy("key").agg(
        F.coalesce(F.max("last_turn") - F.min("least_turn") + 1, F.lit(0).cast("bigint")).alias("span"), F.sum(F.col("gained") - F.col("shared")).alias("turns"),
        *[F.sum(F.col(c) + (F.col("joint") if c == "illegal" else F.lit(0))).alias(c) for c in _SHOWN], whole_audit.alias("audit"),
    )
    many = many.join(digests(split), "key").select("key", (F.col("span") - F.col("turns")).alias("gaps"), *_SHOWN, "audit", "repaired_sha256")
    return one.union(many)


def repair_report(conversations: DataFrame, rows: DataFrame, **sizes: int) -> DataFrame:
    """One row for every conv_id of ``conversations``: what was found in its ``rows`` and what the repair did."""
    found = summaries(*repaired(rows, **sizes))
    ids = conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(_key(), "conv_id")
    joined = ids.join(found.hint("merge"), "key", "left")
    zeros = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", *_SHOWN)]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(given, damaged(given))
