"""Chat formatting after cumulative-snapshot collapse: logged prefixes of longer conversations go.

A conversation that is logged after every turn appears as many rows of turns, each log the prefix
of the next. Rolling hashes of turn prefixes find them: the hash of the first k turns is the
running sum of keyed 32-bit lanes of (place, turn), four lanes wide. Where a whole conversation's
hash is another one's prefix hash it is dropped by an anti-join; of equal conversations that with
the smallest conv_id stays. What is left is rendered in ChatML.

A conversation may hold a large share of all turns: turns are dealt out by range, running sums
are taken inside each range and carried over from totals per range, and rendered text comes in
parts of ``TURNS_PER_PART`` turns, to be read in order. All of it is column expressions.

Results for odd rows: turns are ordered by number (null first), then role, then a digest of role
and text; repeated rows are turns of their own. Null roles and texts are empty. Rows with a null
conv_id are one conversation; it is kept only if no other equals it. Other columns are ignored.
An empty table has no conversations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import parts, table, with_group, written

TURNS_PER_PART = 64
LANES = 4
START, END = "<|im_start|>", "<|im_end|>"
_ORDER = ["turn", "role", "digest"]


def numbered(turns: DataFrame) -> DataFrame:
    """(key, conv_id, place, role, text, prefix lanes p0..): every turn with the rolling hash up to it."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    given = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", "turn",
        role.alias("role"), text.alias("text"), F.sha2(F.concat(role, F.lit("\0"), text), 256).alias("digest"),
    )
    dealt = given.repartitionByRange(parts(turns.sparkSession), "key", *_ORDER)
    dealt = written(dealt.withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("part", "key").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a conversation has a row per range it lies in
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    counts = dealt.groupBy("key", "part").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select("key", "part", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("before"))
    placed = dealt.withColumn("own", F.row_number().over(inside)).join(counts, ["key", "part"])
    placed = placed.withColumn("place", F.col("before") + F.col("own")).drop("before", "own")
    lanes = [f"p{i}" for i in range(LANES)]
    for i, lane in enumerate(lanes):
        mixed = F.xxhash64(F.lit(i), "place", "digest")
        placed = placed.withColumn(lane, F.pmod(mixed, F.lit(1 << 32)))
    placed = written(placed, "places")

    sums = placed.groupBy("key", "part").agg(*[F.sum(c).alias(c) for c in lanes])
    before = sums.select("key", "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"b{c}") for c in lanes])
    running = placed.select("*", *[F.sum(c).over(inside).alias(f"r{c}") for c in lanes]).join(before, ["key", "part"])
    return running.select(
        "key", "conv_id", "place", "role", "text", *[(F.col(f"r{c}") + F.col(f"b{c}")).alias(c) for c in lanes]
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(key, conv_id, n_turns) of the conversations that are no prefix of another, from ``numbered`` turns."""
    lanes = [f"p{i}" for i in range(LANES)]
    ends = turns.groupBy("key").agg(F.max("place").alias("n_turns"))
    with_end = with_group(turns.select("key", "conv_id", "place", *lanes), written(ends, "ends"), "key", "n_turns")
    with_end = written(with_end, "prefixes")
    whole = with_end.where("place = n_turns").groupBy("place", *lanes).agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("unnamed"), "conv_id", "key", "n_turns")).alias("first")
    )
    proper = with_end.where("place < n_turns").select("place", *lanes).distinct()
    return whole.join(proper, ["place", *lanes], "left_anti").select("first.key", "first.conv_id", "first.n_turns")


def rendered(turns: DataFrame, chosen: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """(conv_id, n_turns, part, text): the chosen conversations in ChatML, in parts to be read in order."""
    kept = with_group(turns.select("key", "conv_id", "place", "role", "text"), chosen.drop("conv_id"), "key", "n_turns")
    kept = kept.where("n_turns is not null")
    line = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END + "\n"))
    part = F.floor((F.col("place") - 1) / turns_per_part).alias("part")
    lines = F.array_sort(F.collect_list(F.struct("place", line.alias("line"))))
    return kept.groupBy("key", "conv_id", "n_turns", part).agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("text")
    ).select("conv_id", "n_turns", "part", "text")


def formatted(conversations: DataFrame) -> DataFrame:
    turns = written(numbered(conversations), "numbered")
    return rendered(turns, written(maximal(turns), "maximal"))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"))


ORACLE_OP1 = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
            sha256(coalesce(role, '') || chr(0) || coalesce(text, ''))) AS place,
        count(*) OVER (PARTITION BY conv_id) AS n_turns
    FROM conversations
), h AS (
    SELECT *, md5(string_agg(sha256(role || chr(0) || text), '') OVER (PARTITION BY conv_id ORDER BY place)) AS prefix FROM t
), proper AS (SELECT DISTINCT place, prefix FROM h WHERE place < n_turns
), kept AS (
    SELECT min(conv_id) AS conv_id FROM h WHERE place = n_turns AND (place, prefix) NOT IN (SELECT (place, prefix) FROM proper)
    GROUP BY place, prefix
)
SELECT t.conv_id, n_turns, (place - 1) // {TURNS_PER_PART} AS part,
    string_agg('{START}' || role || chr(10) || text || '{END}' || chr(10), '' ORDER BY place) AS text
FROM t JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL
"""
