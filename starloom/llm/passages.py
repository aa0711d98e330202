"""Substring dedup by hashing runs of lines: the earliest occurrence stays, later ones go.

Units are lines, and within a line clauses: a unit also ends with a word that ends in one of ``.,;:!?``, so that
a passage in the middle of a long line is a run of units too. A unit is normalised - lower case, runs of
blanks as one space - and a *passage* is the shortest run of units from one of at least ``START_WORDS``
words on that has ``MIN_WORDS`` words or more; a paragraph is the passages it is made of. Shorter units and
runs are too common to tell anything and stay. A 128-bit digest stands for a passage. Its occurrences are
grouped over all documents; the first by doc_id and place stays, and what any other one covers is removed.
Overlapping and adjoining passages that go are one removal, whose place in the original text is retained
with the place of the first one's kept occurrence.

Occurrences are counted in the tasks before they shuffle, and only repeated digests are joined back, by
sort-merge joins that split a digest with very many occurrences.

Results for odd rows: null and empty texts have no units. A null doc_id ranks last. Of rows that
share a doc_id the one with the smaller hash of its text ranks first; rows equal in both are one
document, and what it keeps, each of them keeps. Very long texts are many units, taken whole. Other columns
pass through ``without_repeats``; one named ``removed`` is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import BLOCK_CHARS, blocks, small_batches, table, written

MIN_WORDS, START_WORDS = 25, 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_END = re.compile(r"\n|[.,;:!?](?=[\x20\x09-\x0D]|\Z)")
_SPAN = "array<struct<start:int,end:int,kept_doc_id:bigint,kept_start:int>>"


def units(text: str) -> list[tuple[int, list[str]]]:
    """(start, lower-case words) of every unit with a word, in code points. A unit lasts until the next one starts."""
    out, at = [], 0
    for end in [m.end() for m in _END.finditer(text)] + [len(text)]:
        first = _WORD.search(text, at, end)
        if first:
            out.append((first.start(), _WORD.findall(text[at:end].lower())))
        at = end
    return out


def passages(text: str, min_words: int = MIN_WORDS, start_words: int = START_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, digest) of every passage; the end is where the next unit starts."""
    found = units(text)
    starts = [s for s, _ in found] + [len(text)]
    counts = np.cumsum([0, *(len(w) for _, w in found)])
    said = [" ".join(w).encode("utf-8", "surrogatepass") for _, w in found]
    upto = np.searchsorted(counts, counts[:-1] + min_words)  # units up to and including those that reach the size
    out = []
    for i, j in enumerate(upto.tolist()):
        if j > len(found):
            break
        if len(found[i][1]) >= start_words:
            out.append((starts[i], starts[j], hashlib.blake2b(b" ".join(said[i:j]), digest_size=16).digest()))
    return out


def occurrences(docs: DataFrame, min_words: int = MIN_WORDS, start_words: int = START_WORDS) -> DataFrame:
    """(doc_id, tie, start, end, h1, h2) of every passage; the digest as two numbers."""
    small_batches(docs.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", BLOCK_CHARS):
            each = [passages(t, min_words, start_words) for t in rows.column("text").to_pylist()]
            owner = np.repeat(np.arange(len(each)), [len(p) for p in each])
            if not len(owner):
                continue
            digests = np.frombuffer(b"".join(d for p in each for _, _, d in p), "<i8").reshape(-1, 2)
            ends = np.array([(s, e) for p in each for s, e, _ in p], np.int32)
            kept = [rows.column(c).combine_chunks().take(pa.array(owner)) for c in ("doc_id", "tie")]
            columns = [*kept, *(pa.array(np.ascontiguousarray(x)) for x in (ends[:, 0], ends[:, 1], digests[:, 0], digests[:, 1]))]
            yield pa.record_batch(columns, ["doc_id", "tie", "start", "end", "h1", "h2"])

    given = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return given.mapInArrow(found, "doc_id bigint, tie bigint, start int, end int, h1 bigint, h2 bigint")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, start_words: int = START_WORDS) -> DataFrame:
    """(doc_id, tie, start, end, kept_doc_id, kept_start): every occurrence but the first of its passage."""
    every = written(occurrences(docs, min_words, start_words), "passages")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), "tie", "start")
    first = every.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("m")).where("m > 1")
    first = written(first.select("h1", "h2", "first.id", F.col("first.tie").alias("kt"), F.col("first.start").alias("ks")), "firsts")
    found = every.join(first.hint("merge"), ["h1", "h2"])
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("kt")) & (F.col("start") == F.col("ks"))
    return found.where(~same).select("doc_id", "tie", "start", "end", F.col("id").alias("kept_doc_id"), F.col("ks").alias("kept_start"))


def _merged(spans: pa.Array) -> pa.Array:
    """Sorted passages that overlap or adjoin as one, with the first one's kept place."""
    out = []
    for found in spans.to_pylist():
        joined: list[dict] = []
        for s in found or []:
            if joined and s["start"] <= joined[-1]["end"]:
                joined[-1]["end"] = max(joined[-1]["end"], s["end"])
            else:
                joined.append(dict(s))
        out.append(joined)
    kinds = (("start", pa.int32()), ("end", pa.int32()), ("kept_doc_id", pa.int64()), ("kept_start", pa.int32()))
    return pa.array(out, pa.list_(pa.struct(kinds)))


def _cut_out(text: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, gone in zip(text.to_pylist(), spans.to_pylist(), strict=True):
        left, at = [], 0
        for s in gone:
            left.append(t[at : s["start"]])
            at = s["end"]
        out.append("".join(left) + t[at:])
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, start_words: int = START_WORDS) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and ``removed``: (start, end, kept_doc_id, kept_start) of each removal.

    A text's list is no longer than its units; texts without repeats have an empty one.
    """
    span = F.struct("start", "end", "kept_doc_id", "kept_start")
    spans = repeats(docs, min_words, start_words).groupBy("doc_id", "tie").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    spans = written(spans.select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.arrow_udf(_merged, _SPAN)("spans").alias("_removed")), "removed")
    given = docs.drop("removed")
    joined = given.join(spans, F.xxhash64(given["text"]).eqNullSafe(F.col("_tie")) & given["doc_id"].eqNullSafe(F.col("_id")), "left")
    # only texts that lose something go to Python
    changed = joined.where(F.col("_removed").isNotNull())
    changed = changed.select(
        *[F.arrow_udf(_cut_out, "string")(given["text"], F.col("_removed")).alias("text") if c == "text" else given[c] for c in given.columns],
        F.col("_removed").alias("removed"),
    )
    same = joined.where(F.col("_removed").isNull())
    same = same.select(*[given[c] for c in given.columns], F.array().cast(_SPAN).alias("removed"))
    return same.union(changed)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: what is left of it, and which spans of the original went and where they are kept."""
    cleaned = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = F.transform("removed", lambda s: F.concat_ws("", s["start"], F.lit("-"), s["end"], F.lit(">"), s["kept_doc_id"], F.lit(":"), s["kept_start"]))
    return cleaned.select("doc_id", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(shown, ",").alias("removed"), "text")


ORACLE_OP8 = rf"""
WITH cut AS (
    SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS p FROM (
        SELECT doc_id, string_split(replace(regexp_replace(text, '([.,;:!?])([ \t-\r])', '\1' || chr(1) || '\2', 'g'),
            chr(10), chr(10) || chr(1)), chr(1)) AS pieces FROM documents)
), placed AS (
    SELECT doc_id, p, regexp_extract_all(piece, '[^ \t-\r]+') AS words,
        sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY p) - length(regexp_replace(piece, '^[ \t-\r]+', '')) AS start
    FROM cut
), unit AS (
    SELECT doc_id, start, len(words) AS n, lower(array_to_string(words, ' ')) AS said,
        row_number() OVER w AS i, sum(len(words)) OVER w AS upto
    FROM placed WHERE len(words) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY p)
), whole AS (
    SELECT doc_id, list(said ORDER BY i) AS said, list(start ORDER BY i) AS starts FROM unit GROUP BY doc_id
), passage AS (
    SELECT a.doc_id, a.i, b.i AS j, a.start, array_to_string(w.said[a.i:b.i], ' ') AS said,
        coalesce(w.starts[b.i + 1], length(d.text)) AS stop
    FROM unit a ASOF JOIN unit b ON a.doc_id = b.doc_id AND a.upto - a.n + {MIN_WORDS} <= b.upto
    JOIN whole w ON a.doc_id = w.doc_id JOIN documents d ON a.doc_id = d.doc_id WHERE a.n >= {START_WORDS}
), ranked AS (
    SELECT *, first_value(doc_id) OVER w AS kept_doc, first_value(start) OVER w AS kept_start
    FROM passage WINDOW w AS (PARTITION BY said ORDER BY doc_id, start)
), gone AS (
    SELECT *, start > max(stop) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS apart
    FROM ranked WHERE (kept_doc, kept_start) <> (doc_id, start)
), numbered AS (
    SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start) AS k FROM gone
), removal AS (
    SELECT doc_id, k, min(start) AS start, max(stop) AS stop, arg_min(kept_doc, start) AS kept_doc, arg_min(kept_start, start) AS kept_start
    FROM numbered GROUP BY doc_id, k
), left_over AS (
    SELECT u.doc_id, string_agg(substring(d.text, u.start::BIGINT + 1, (coalesce(w.starts[u.i + 1], length(d.text)) - u.start)::BIGINT), '' ORDER BY u.i)
        FILTER (NOT EXISTS (SELECT 1 FROM removal r WHERE r.doc_id = u.doc_id AND u.start >= r.start AND u.start < r.stop)) AS rest,
        min(u.start) AS lead
    FROM unit u JOIN whole w ON u.doc_id = w.doc_id JOIN documents d ON u.doc_id = d.doc_id GROUP BY u.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n, string_agg(start::BIGINT || '-' || stop::BIGINT || '>' || kept_doc || ':' || kept_start::BIGINT, ',' ORDER BY start) AS spans
    FROM removal GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_removed, coalesce(spans, '') AS removed,
    CASE WHEN n IS NULL THEN d.text ELSE substring(d.text, 1, lead::BIGINT) || coalesce(rest, '') END AS text
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""
