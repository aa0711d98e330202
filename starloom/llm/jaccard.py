"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

Five-word shingles of lower-cased words; texts are linked when the Jaccard similarity of their
shingle sets is 0.8 or more. ``plan_bands`` picks band and row counts for a target recall at
that similarity. The steps:

1. Every document is signed in its scan task. Documents with equal sets become one node with a
   number of copies, so a group of copies, however large, is one node from here on.
2. Band hashes are counted; only those shared by several nodes go on.
3. Nodes of one band hash meet in blocks of bounded size and are tied together where their
   signatures do not exclude a link (six standard deviations below the threshold). A block emits
   a spanning forest, not its pairs.
4. Connected families hold every link inside them. Each pair of blocks of a family is checked
   once on full shingle sets, by set sizes and intersections; links are counted, and a spanning
   forest of them goes on.
5. Connected classes of verified links.

Results for odd rows: null and empty texts, and rows without a doc_id, have no links; such a
document is a class of its own. Texts of one to four words are one shingle, so equal ones are
linked. Rows with equal texts link with each other, also if they share a doc_id. Ties: the
smallest doc_id names the class. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import (
    U64,
    Words,
    blocks,
    components,
    groups,
    mix,
    pairs_of_blocks,
    parts,
    runs,
    signed,
    small_batches,
    table,
    with_group,
    written,
    with_row_ids,
)

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 256
#: Nodes of one block; a task holds two blocks, and the pairs between them, at a time.
BLOCK = 512
#: Columns of the block's shingle table that are multiplied at once.
COLUMNS = 4096


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): most rows, thus fewest false candidates, whose bands reach the recall within the hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


# --- signatures


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): text i has the sorted distinct hashes[bounds[i]:bounds[i + 1]]."""
    words = Words([(t or "").lower() for t in texts])
    h1, o1 = words.shingles(SHINGLE)
    h2, o2 = words.whole(SHINGLE)
    hashes, owner = np.concatenate([h1, h2]), np.concatenate([o1, o2])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def node_ids(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set: equal sets are equal in both."""
    out = []
    for salt in (0x8BB84B93962EACC9, 0x2D358DCCAA6C78A5):
        upto = np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashes ^ U64(salt)), dtype=U64)])
        total = upto[bounds[1:]] - upto[bounds[:-1]]
        out.append(signed(mix(total + U64(salt) * np.diff(bounds).astype(U64))))
    return out[0], out[1]


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
    return seeds[:n] | U64(1), seeds[n:]


def minhashes(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(sets, n) minima of n hash functions, 32 bits each; sets must not be empty."""
    a, b = _coefficients(n)
    out = np.empty((len(bounds) - 1, n), np.uint32)
    step = 1 << 15
    for i in range(n):
        least = np.full(len(bounds) - 1, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(hashes), step):  # stretches that stay in the processor's cache
            part = hashes[at : at + step]
            high = ((part * a[i] + b[i]) >> U64(32)).astype(np.uint32)
            lo = int(np.searchsorted(bounds, at, "right")) - 1
            hi = int(np.searchsorted(bounds, at + len(part), "left"))
            cuts = np.maximum(bounds[lo:hi] - at, 0)
            least[lo:hi] = np.minimum(least[lo:hi], np.minimum.reduceat(high, cuts))
        out[:, i] = least
    return out


SIGNED = "doc_id bigint, node bigint, check bigint, size int, signature binary, buckets array<bigint>"


def signatures(docs: DataFrame, n_bands: int, n_rows: int) -> DataFrame:
    """Per document with words: its set's digests and size, one byte per hash function, band hashes."""
    n = n_bands * n_rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            hashes, bounds = shingle_sets(rows.column("text").to_pylist())
            full = np.flatnonzero(np.diff(bounds))
            if not len(full):
                continue
            bounds = np.concatenate([bounds[full], [len(hashes)]])
            node, check = node_ids(hashes, bounds)
            least = minhashes(hashes, bounds, n)
            bands = np.zeros((len(full), n_bands), U64)
            for r in range(n_rows):
                bands = bands * U64(0x9E3779B97F4A7C15) + least[:, r::n_rows].astype(U64) + U64(1)
            bands = mix(bands + np.arange(1, n_bands + 1, dtype=U64) * U64(0xD1342543DE82EF95))
            yield pa.record_batch(
                [
                    rows.column("doc_id").combine_chunks().take(pa.array(full)),
                    pa.array(node),
                    pa.array(check),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.array([x.tobytes() for x in (least & 0xFF).astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(
                        np.arange(0, len(full) * n_bands + 1, n_bands, dtype=np.int32), pa.array(signed(bands.ravel()))
                    ),
                ],
                schema=pa.schema([
                    ("doc_id", pa.int64()), ("node", pa.int64()), ("check", pa.int64()), ("size", pa.int32()),
                    ("signature", pa.binary()), ("buckets", pa.list_(pa.int64())),
                ]),
            )

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(sign, SIGNED)


# --- candidates


def excluded_below(n: int, threshold: float) -> float:
    """Share of equal signature bytes below which a link is out of the question (six deviations)."""
    return threshold - 6 * np.sqrt(threshold * (1 - threshold) / n)


def _forest(near: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric adjacency matrix."""
    out, seen = [], np.zeros(len(ids), bool)
    for i in range(len(ids)):
        if seen[i]:
            continue
        seen[i] = True
        front = np.array([i])
        while len(front):
            reach = near[front].any(axis=0) & ~seen
            front = np.flatnonzero(reach)
            seen |= reach
            out += [(int(ids[i]), int(ids[j])) for j in front]
    return out


def _alike(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Matrix of pairs with at least that share of equal signature bytes."""
    out = np.empty((len(a), len(b)), bool)
    for i in range(0, len(a), 32):
        out[i : i + 32] = (a[i : i + 32, None, :] == b[None, :, :]).mean(axis=2) >= least
    return out


def candidate_edges(nodes: DataFrame, n_hashes: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """(a, b): enough edges that nodes which may be linked are connected."""
    least = excluded_below(n_hashes, threshold)
    held = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = written(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "buckets")
    members = with_group(held, shared, "bucket", "m", shuffled=True).where("m is not null")
    members = members.join(nodes.select("node", "signature").hint("merge"), "node")
    n_blocks = F.ceil(F.col("m") / block).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("block")), n_blocks).cast("int")
    spread = (
        members.withColumns({"n_blocks": n_blocks, "own": own})
        .select("bucket", "node", "own", "signature", F.explode(pairs_of_blocks(F.col("n_blocks"), F.col("own"))).alias("p"))
        .select("bucket", "p.i", "p.j", "node", "own", "signature")
    )
    keys = ["bucket", "i", "j"]

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, keys):
            at = runs(rows, keys)
            node, own = rows.column("node").to_numpy(), rows.column("own").to_numpy()
            i, j = rows.column("i").to_numpy(), rows.column("j").to_numpy()
            sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint8).reshape(len(node), n_hashes)
            size = np.diff(at)
            two = at[:-1][size == 2]
            close = two[(sig[two] == sig[two + 1]).mean(axis=1) >= least]
            edges = list(zip(node[close].tolist(), node[close + 1].tolist(), strict=True))
            for s, e in zip(at[:-1][size > 2], at[1:][size > 2], strict=True):
                near = _alike(sig[s:e], sig[s:e], least)
                if i[s] != j[s]:  # pairs inside a block are another task's
                    near &= own[s:e, None] != own[None, s:e]
                edges += _forest(near, node[s:e])
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    dealt = spread.repartition(parts(nodes.sparkSession), *keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(tie, "a bigint, b bigint").distinct()


# --- verification on full sets


def _links(sets: list[np.ndarray], inside: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of pairs whose sets have at least that Jaccard similarity; ``inside`` marks pairs to look at."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        common = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))]] * 2)
        common = np.maximum(common, common.T)
    else:
        flat = np.concatenate(sets)
        _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        row, several = np.repeat(np.arange(len(sets)), size), times > 1
        number = np.cumsum(several) - 1
        use = several[column]
        row, column = row[use], number[column[use]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for at in range(0, int(several.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, [at, at + COLUMNS])
            table_ = np.zeros((len(sets), COLUMNS), np.float32)
            table_[row[lo:hi], column[lo:hi] - at] = 1
            common += table_ @ table_.T
    both = size[:, None] + size[None, :] - common
    return (common >= threshold * both - 1e-9) & inside


def verified(docs: DataFrame, families: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, root, links): per pair of blocks a node's links there, weighted by copies, and a tree edge."""
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("m"))
    placed = with_group(families, sizes, "family", "m")
    placed = placed.withColumn("n_blocks", F.ceil(F.col("m") / block).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("node", F.lit("place")), F.col("n_blocks")).cast("int"))
    needed = placed.select("doc_id", "node", "family", "n_blocks", "own", "copies").hint("merge")
    found = docs.select("doc_id", "text").join(needed, "doc_id")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            hashes, bounds = shingle_sets(rows.column("text").to_pylist())
            node, _ = node_ids(hashes, bounds)
            right = np.flatnonzero(node == rows.column("node").to_numpy())  # another row may share the doc_id
            chosen = rows.drop_columns(["doc_id", "text"]).take(pa.array(right))
            content = [hashes[bounds[k] : bounds[k + 1]].tobytes() for k in right]
            yield from chosen.append_column("content", pa.array(content, pa.binary())).combine_chunks().to_batches()

    sets = found.mapInArrow(expand, "node bigint, family bigint, n_blocks int, own int, copies bigint, content binary")
    spread = sets.select(
        "family", "node", "own", "copies", "content", F.explode(pairs_of_blocks(F.col("n_blocks"), F.col("own"))).alias("p")
    ).select("family", "p.i", "p.j", "node", "own", "copies", "content")
    keys = ["family", "i", "j"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, keys):
            at = runs(rows, keys)
            out: list[tuple[int, int, int]] = []
            for s, e in zip(at[:-1], at[1:], strict=True):
                part = rows.slice(s, e - s)
                node, keep = np.unique(part.column("node").to_numpy(), return_index=True)
                if len(node) < 2:
                    continue
                own = part.column("own").to_numpy()[keep]
                copies = part.column("copies").to_numpy()[keep]
                content = part.column("content").take(pa.array(keep)).to_pylist()
                inside = ~np.eye(len(node), dtype=bool)
                if part.column("i")[0] != part.column("j")[0]:
                    inside &= own[:, None] != own[None, :]
                linked = _links([np.frombuffer(c, U64) for c in content], inside, threshold)
                root = node.copy()
                for a, b in _forest(linked, np.arange(len(node))):
                    root[b] = node[a]
                n = linked @ copies
                out += [(int(x), int(r), int(k)) for x, r, k in zip(node, root, n, strict=True) if k]
            if out:
                cols = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.record_batch(cols, ["node", "root", "links"])

    dealt = spread.repartition(parts(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(verify, "node bigint, root bigint, links bigint")


# --- the join


def linked_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links) for every row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the connected class, ``n_links`` the number of other
    rows whose sets are similar enough.
    """
    small_batches(docs.sparkSession)
    n_bands, n_rows = plan_bands(threshold, recall)
    every = written(signatures(docs, n_bands, n_rows), "signatures")
    first = F.min_by(F.struct("signature", "buckets"), F.struct("doc_id", "signature"))
    nodes = written(
        every.groupBy("node", "check")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"), first.alias("s"))
        .select("node", "copies", "doc_id", "s.signature", "s.buckets"),
        "nodes",
    )
    maybe = components(candidate_edges(nodes, n_bands * n_rows, threshold))
    families = nodes.select("node", "doc_id", "copies").join(maybe.withColumnRenamed("root", "family"), "node")
    checked = written(verified(docs, written(families, "families"), threshold), "links")
    roots = written(components(checked.select(F.col("node").alias("a"), F.col("root").alias("b"))), "roots")
    counts = checked.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "doc_id", "copies").join(roots, "node", "left").join(counts, "node", "left")
    named = written(named.withColumn("root", F.coalesce("root", "node")), "named")
    class_of = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    per_node = named.join(class_of, "root").select(
        "node", "copies", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    with_words = with_group(every.select("doc_id", "node"), written(per_node, "classes"), "node", "copies")
    with_words = with_words.select("doc_id", "class_id", "n_links")
    wordless = docs.where(F.col("doc_id").isNull() | F.coalesce(_wordless(), F.lit(True))).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return with_words.union(wordless)


def _wordless() -> F.Column:
    return ~F.col("text").rlike(r"[^\x20\x09-\x0D]")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class, that with the smallest doc_id (null last; of rows that share it any one, the same at every attempt).

    Texts without words have nothing in common and all stay.
    """
    rows = with_row_ids(docs, "__row")
    # rows take part under a number that orders them by doc_id where that is possible
    classes = linked_classes(rows.select(F.col("__row").alias("doc_id"), "text"))
    classes = classes.select(F.col("doc_id").alias("__row"), F.col("class_id").alias("__class"))
    named = written(rows.select("__row", "doc_id").join(classes.hint("merge"), "__row"), "row-classes")
    first = named.groupBy("__class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row")).alias("first"))
    others = named.join(first.select("__class", F.col("first.__row").alias("__first")).hint("merge"), "__class").where("__row <> __first")
    return rows.join(written(others.select("__row"), "others").hint("merge"), "__row", "left_anti").select(*docs.columns)


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_classes(table(spark, sf_dir, "documents"))
