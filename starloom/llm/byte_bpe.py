"""Byte-level BPE over distinct words: encode every word once, join the ids back, decode by table.

Texts are cut where every pre-token boundary is certain: before a space that stands between two
characters that are no blanks. The pieces ("words", with their space) never share a pre-token,
so the ids of a text are those of its words in order.

1. Documents are gathered in blocks. A block keeps each text, in a file of its own, as the
   positions of its words in the block's word list, and sends the list, cut by word hash, to
   the shuffle.
2. One task meets all occurrences of a word, encodes it once, pre-token by pre-token, and sends
   the ids back in the order of the list they came from.
3. Lists and documents of a block meet again; ids are put together by position, and decoding
   looks every id up in the table of token bytes.

A word that stands in every text costs one entry per block. Blocks are bounded by characters;
only a single longer text makes a longer block.

Results for odd rows: null and empty texts have no ids. Null doc_ids and repeated rows are kept;
each row is encoded. Other columns are ignored. Texts of blanks only are one word. Ties do not
occur: BPE merges by rank.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import blocks, parts, small_batches, table, written
from starloom.llm.files import create, open_seekable
from starloom.sources.workspace import new_folder

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Bytes of text in one block of documents.
BLOCK_BYTES = 12_000_000
#: Words of a block that are numbered by frequency.
FREQUENT = 1 << 14
_CUT, _TWO_BLANKS = re.compile(r"(?<=\S) (?=\S)"), re.compile(r"\s\s")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


@functools.cache
def token_bytes(path: str) -> tuple[bytes | None, ...]:
    """The token-byte table: by id."""
    ranks = read_ranks(path)
    out: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return tuple(out)


def words_of(text: str) -> list[str]:
    """The text's words, each but the first with the space before it."""
    if not text:
        return []
    cut = bare_words(text)
    return [cut[0], *[" " + w for w in cut[1:]]]


def bare_words(text: str) -> list[str]:
    """The text's words without the spaces between them."""
    if _TWO_BLANKS.search(text) or text[:1].isspace() or text[-1:].isspace():
        return _CUT.split(text)
    return text.split(" ")  # the same, as every space stands between two other characters


def packed(*parts_: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts_))


def unpacked(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes: the upper ones of small numbers compress to nothing."""
    return np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes, n: int, at: int = 0) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def packed_texts(doc_ids: list[int | None], texts: list[np.ndarray], n_words: int) -> bytes:
    """The documents of a block: their ids, their lengths and the places of their words.

    The ``FREQUENT`` most common places are renumbered by frequency, which compresses well; the
    others follow in their own order.
    """
    codes = np.concatenate([np.empty(0, np.int64), *texts]).astype(np.int64)
    often = np.bincount(codes, minlength=n_words)
    top = np.argsort(-often, kind="stable")[:FREQUENT]
    known = np.array([x is not None for x in doc_ids], np.uint8)
    ids = np.array([x or 0 for x in doc_ids], np.int64)
    rank = np.argsort(_by_rank(top, n_words))
    head = np.array([len(doc_ids), len(codes), n_words, len(top)], "<u4").tobytes()
    lengths = np.array([len(t) for t in texts], np.uint32)
    return packed(head, known.tobytes(), ids.tobytes(), planes(lengths), planes(top), planes(rank[codes]))


def _by_rank(top: np.ndarray, n_words: int) -> np.ndarray:
    """The place of each rank."""
    rest = np.ones(n_words, bool)
    rest[top] = False
    return np.concatenate([top.astype(np.int64), np.flatnonzero(rest)])


def unpacked_texts(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, words per document, places of all words in order)."""
    raw = unpacked(data)
    n, total, n_words, n_top = np.frombuffer(raw, "<u4", 4).tolist()
    known = np.frombuffer(raw, np.uint8, n, 16)
    ids = np.frombuffer(raw, np.int64, n, 16 + n)
    at = 16 + 9 * n
    lengths, at = from_planes(raw, n, at), at + 4 * n
    top, at = from_planes(raw, n_top, at), at + 4 * n_top
    places = _by_rank(top, n_words)[from_planes(raw, total, at)]
    return [x if k else None for x, k in zip(ids.tolist(), known.tolist(), strict=True)], lengths, places


def packed_list(items: list[bytes]) -> bytes:
    return packed(planes(np.fromiter(map(len, items), np.uint32, len(items))), b"".join(items))


def unpacked_list(n: int, data: bytes) -> list[bytes]:
    raw = unpacked(data)
    ends = np.cumsum(from_planes(raw, n), dtype=np.int64) + 4 * n
    starts = np.concatenate([[4 * n], ends[:-1]])
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def packed_ids(items: list[bytes]) -> bytes:
    """Like a list, with the ids' bytes in planes."""
    lengths = np.fromiter(map(len, items), np.uint32, len(items))
    return packed(planes(lengths), planes(np.frombuffer(b"".join(items), "<u4")))


def unpacked_ids(n: int, data: bytes) -> list[bytes]:
    raw = unpacked(data)
    ends = np.cumsum(from_planes(raw, n), dtype=np.int64)
    ids = from_planes(raw, (len(raw) - 4 * n) // 4, 4 * n).tobytes()
    starts = np.concatenate([[0], ends[:-1]])
    return [ids[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


PIECE = "block string, list int, n int, data binary"
_NAMES = ["block", "list", "n", "data"]


def _pieces(rows: list[tuple[str, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _NAMES)


def word_blocks(docs: DataFrame, n_lists: int, folder: str) -> DataFrame:
    """(block, list, n, data): the word lists of each block, and a row for its documents (list -1).

    List ``k`` has the block's distinct words whose hash falls into ``k``, sorted; places count
    through the lists in order. The documents themselves, as places, go to a file of the block's
    name in ``folder``: they are needed once, whole, and spare the shuffle.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text", BLOCK_BYTES):
            block = uuid.uuid4().hex
            seen: dict[str, int] = {}
            number = seen.setdefault
            texts = [
                np.array([number(w, len(seen)) for w in words_of(t or "")], np.int64) for t in rows.column("text").to_pylist()
            ]
            words = [w.encode("utf-8", "surrogatepass") for w in seen]
            where = [zlib.crc32(w) % n_lists for w in words]
            order = sorted(range(len(words)), key=lambda i: (where[i], words[i]))
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            lists: dict[int, list[bytes]] = {}
            for i in order:
                lists.setdefault(where[i], []).append(words[i])
            content = packed_texts(rows.column("doc_id").to_pylist(), [place[t] for t in texts], len(words))
            with create(f"{folder}/{block}") as out:
                out.write(content)
            yield _pieces([(block, -1, len(texts), b"")])
            if lists:
                yield _pieces([(block, k, len(own), packed_list(own)) for k, own in lists.items()])

    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(cut, PIECE)


def encoded_lists(lists: DataFrame, path: str) -> DataFrame:
    """Each word list with ids instead of words: every distinct word is encoded once, by the task of its list number."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = encoder(path).encode_ordinary
        known: dict[bytes, bytes] = {}
        current = None
        for batch in batches:
            out = []
            for block, k, n, data in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if k != current:  # lists come sorted by number: other words from here on
                    current, known = k, {}
                words = unpacked_list(n, data)
                for w in words:
                    if w not in known:
                        known[w] = np.array(one(w.decode("utf-8", "surrogatepass")), "<u4").tobytes()
                out.append((block, k, n, packed_ids(list(map(known.__getitem__, words)))))
            if out:
                yield _pieces(out)

    dealt = lists.repartition(parts(lists.sparkSession), "list").sortWithinPartitions("list")
    return dealt.mapInArrow(encode, PIECE)


def assembled(pieces: DataFrame, path: str, folder: str) -> DataFrame:
    """(doc_id, ids binary, decoded binary): a block's lists and documents together again."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = token_bytes(path)
        ids_of: list[bytes] = []
        current = None
        for batch in batches:  # sorted by block, its lists first and in order, then its documents
            for block, k, n, data in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if block != current:
                    current, ids_of = block, []
                if k >= 0:
                    ids_of += unpacked_ids(n, data)
                    continue
                with open_seekable(f"{folder}/{block}") as file:
                    doc_ids, lengths, places = unpacked_texts(file.read())
                ends = np.cumsum(lengths, dtype=np.int64)
                for at in range(0, n, 64):
                    rows = []
                    for i in range(at, min(at + 64, n)):
                        own = places[ends[i] - lengths[i] : ends[i]].tolist()
                        ids = b"".join(map(ids_of.__getitem__, own))
                        text = b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                        rows.append((doc_ids[i], ids, text))
                    kinds = (pa.int64(), pa.binary(), pa.binary())
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.record_batch(cols, ["doc_id", "ids", "decoded"])

    ordered = pieces.withColumn("late", F.col("list") < 0)
    dealt = ordered.repartition(parts(pieces.sparkSession), "block").sortWithinPartitions("block", "late", "list")
    return dealt.select(*_NAMES).mapInArrow(put, "doc_id bigint, ids binary, decoded binary")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): little-endian unsigned 32-bit ids of each text and the bytes they stand for."""
    small_batches(docs.sparkSession)
    folder = new_folder(docs.sparkSession, "word-places")
    pieces = written(word_blocks(docs, parts(docs.sparkSession), folder), "word-lists")
    lists = encoded_lists(pieces.where("list >= 0"), path)
    return assembled(pieces.where("list < 0").unionByName(lists), path, folder)


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, shown, plain = [], [], []
            for ids, decoded in zip(batch.column("ids").to_pylist(), batch.column("decoded").to_pylist(), strict=True):
                values = np.frombuffer(ids, np.uint32).tolist()
                n.append(len(values))
                shown.append(hashlib.sha256(",".join(map(str, values)).encode()).hexdigest())
                plain.append(hashlib.sha256(decoded).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(shown, pa.string()), pa.array(plain, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return coded.mapInArrow(work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def coded_digests(docs: DataFrame) -> DataFrame:
    return digests(encode_and_decode(docs, public_tokenizers.path(RANKS)))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return coded_digests(docs)


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_digests(table(spark, sf_dir, "documents"))
