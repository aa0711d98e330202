"""Token ids in binary files: one zstandard frame per document, a shared dictionary, an offset index.

A file is: magic, width of an id in bytes, SHA-256 of the dictionary, one frame per document
(its ids, little-endian unsigned, compressed with the dictionary), the index, its place and
size, magic. The index holds doc_id, number of ids, offset and size of each frame, so one short
document is read with two small reads. The dictionary lies in a file of its own beside them; a
reader refuses a file whose dictionary hash differs.

The dictionary is trained on the ids of at most ``SAMPLE_DOCS`` documents (those with the
smallest hashes of doc_id and length), ``SAMPLE_IDS`` ids of each.

Texts are cut into pieces where a pre-token certainly ends (``cuts``), so the ids of a text are those
of its pieces in order. Every distinct piece of a block of documents is looked up once; a worker
remembers the last ``KNOWN_WORDS`` pieces and up to as many before them, and the tokenizers library
encodes those it does not know. Every document ends with ``END``. Documents lie in ascending order of doc_id, null first; rows that share a doc_id in
order of a hash of their text.

Results for odd rows: a null or empty text is the end id alone. Repeated rows are stored each.
An empty table makes no files. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import blocks, parts, small_batches, table, written
from starloom.llm.files import create, open_seekable
from starloom.sources.workspace import new_folder

TOKENIZER = "byte_bpe_50k.json"
END = 0
MAGIC = b"SLTOKID1"
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 2048, 64 * 1024
KNOWN_WORDS = 600_000
#: Bytes of text that are encoded at a time.
BLOCK_BYTES = 6_000_000
FILE_BYTES = 64 * 1024 * 1024
LEVEL = 3
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "<u1"), ("n", "<u4"), ("offset", "<u8"), ("size", "<u4")])
_TAIL = struct.Struct("<QQ8s")


# --- encoding


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _added(path: str) -> tuple[bytes, ...]:
    """Texts that are a token wherever they stand."""
    return tuple(t.content.encode() for t in tokenizer(path).get_added_tokens_decoder().values())


@functools.cache
def id_type(path: str) -> np.dtype:
    return np.dtype("<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")


_ASCII = np.arange(256) < 128
_LETTERS = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_SOLID = np.arange(256) > 32
_MARKS = _ASCII & _SOLID & ~_LETTERS & ~np.isin(np.arange(256), np.frombuffer(b"0123456789'\x7f", np.uint8))
#: First bytes of the characters beyond ASCII that are blanks, with the second bytes that blanks have.
_BLANKS = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}
_ONE = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")


def cuts(data: np.ndarray, whole: tuple[bytes, ...] = ()) -> np.ndarray:
    """Whether a piece starts at each byte of UTF-8 text; ``whole`` texts are not cut.

    Letters are A to Z and those of U+00C0 to U+00FF. Pieces start where a pre-token of the byte-level
    pattern starts whatever stands around: before a space between two characters that are no blanks,
    after a single line feed between two, between a letter and another ASCII character, and between an
    ASCII mark other than an apostrophe and a letter. All else stays together.
    """
    letter, solid = _LETTERS[data], _SOLID[data]
    two = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter[:-1] |= two
    letter[1:] |= two
    for first, seconds in _BLANKS.items():
        at = np.flatnonzero(data[:-1] == first)
        at = at[np.isin(data[at + 1], seconds)]
        for k in range(3):
            solid[np.minimum(at + k, len(data) - 1)] = False
    cut = np.zeros(len(data), bool)
    cut[1:] = letter[:-1] & (_ASCII & ~_LETTERS)[data[1:]]
    cut[1:] |= _MARKS[data[:-1]] & letter[1:]
    between = solid[:-2] & solid[2:]
    cut[1:-1] |= between & (data[1:-1] == 0x20)
    cut[2:] |= between & (data[1:-1] == 0x0A)
    for one in whole:
        for found in re.finditer(re.escape(one), data):
            cut[found.start() + 1 : found.end()] = False
    return cut


@functools.cache
def _bytes_shown() -> list[str]:
    """The character that stands for each byte in the vocabulary of a byte-level BPE."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


@functools.cache
def _remembered(path: str) -> list[dict[str, bytes]]:
    """Pieces and their ids: those met lately, and those before them."""
    return [{}, {}]


def _encoded_pieces(pieces: list[str], path: str) -> list[bytes]:
    """The ids of distinct pieces. One pre-token goes straight to the library's model, all else through its whole way."""
    kind, known = id_type(path), _remembered(path)
    if len(known[0]) > KNOWN_WORDS:
        known[:] = [{}, known[0]]
    lately, before = known
    out = list(map(lately.get, pieces))
    missing = [i for i, ids in enumerate(out) if ids is None]
    new = []
    for i in missing:
        ids = before.get(pieces[i])
        if ids is None:
            new.append(i)
        else:
            out[i] = lately[pieces[i]] = ids
    code = kind.char
    one = [i for i in new if _ONE.fullmatch(pieces[i])]
    shown, model = _bytes_shown(), tokenizer(path).model
    for i in one:
        text = pieces[i].encode().decode("latin-1").translate(shown)
        out[i] = lately[pieces[i]] = array(code, [t.id for t in model.tokenize(text)]).tobytes()
    rest = [i for i in new if out[i] is None]
    ids = tokenizer(path).encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)
    for i, e in zip(rest, ids, strict=True):
        out[i] = lately[pieces[i]] = array(code, e.ids).tobytes()
    return out


def encoded(texts: list[str | None] | pa.Array | pa.ChunkedArray, path: str) -> list[bytes]:
    """The ids of each text and the end id, little-endian."""
    kind = id_type(path)
    given = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
    given = pc.fill_null(given.combine_chunks() if isinstance(given, pa.ChunkedArray) else given, "")
    if not len(given):
        return []
    _, places, content = given.buffers()
    ends = np.frombuffer(places, np.int64)[given.offset : given.offset + len(given) + 1]
    data = np.frombuffer(content or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    cut = cuts(data, _added(path))
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    bounds = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
    ids = [*_encoded_pieces(pieces.dictionary.to_pylist(), path), np.array([END], kind).tobytes()]
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // kind.itemsize
    upto = np.searchsorted(starts, ends[1:])  # pieces before each text's end, where the end id goes
    codes = np.insert(pieces.indices.to_numpy().astype(np.int64), upto, len(ids) - 1)
    n = size[codes]
    stop = np.cumsum(n)
    at = np.repeat((np.cumsum(size) - size)[codes] - (stop - n), n) + np.arange(stop[-1])
    raw = np.frombuffer(b"".join(ids), kind)[at].tobytes()
    last = (stop[upto + np.arange(len(given))] * kind.itemsize).tolist()
    return [raw[a:b] for a, b in zip([0, *last], last, strict=False)]


def dictionary(docs: DataFrame, path: str) -> bytes:
    """A zstandard dictionary from a bounded sample of documents; raw ids where they are too few to train on."""
    mark = F.xxhash64("doc_id", F.length("text"))
    sample = docs.select("text", mark.alias("mark")).orderBy("mark").limit(SAMPLE_DOCS).select("text")
    width = id_type(path).itemsize

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(batches, "text"):
            ids = [x[: SAMPLE_IDS * width] for x in encoded(rows.column("text"), path)]
            yield pa.record_batch([pa.array(ids, pa.binary())], ["ids"])

    given = sorted(bytes(r[0]) for r in sample.mapInArrow(head, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, given).as_bytes()
    except zstandard.ZstdError:
        return b"".join(given)[:DICTIONARY_BYTES]


def loaded(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


# --- files


class Writer:
    """One file, filled frame by frame."""

    def __init__(self, uri: str, content: bytes, width: int):
        self.uri, self.out = uri, create(uri)
        self.press = zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded(content), write_dict_id=False)
        head = MAGIC + bytes([width]) + hashlib.sha256(content).digest()
        self.out.write(head)
        self.at, self.width, self.index, self.n_ids = len(head), width, [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.press.compress(ids)
        self.out.write(frame)
        n = len(ids) // self.width
        self.index.append((doc_id or 0, doc_id is not None, n, self.at, len(frame)))
        self.at += len(frame)
        self.n_ids += n

    def close(self) -> tuple[str, int, int]:
        index = zstandard.ZstdCompressor().compress(np.array(self.index, _INDEX).tobytes())
        self.out.write(index + _TAIL.pack(self.at, len(index), MAGIC))
        self.out.close()
        return self.uri, len(self.index), self.n_ids


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, uri: str, content: bytes):
        self.file = open_seekable(uri)
        head = self.file.read(len(MAGIC) + 33)
        self.file.seek(self.file.size() - _TAIL.size)
        at, size, magic = _TAIL.unpack(self.file.read(_TAIL.size))
        if head[: len(MAGIC)] != MAGIC or magic != MAGIC:
            raise ValueError(f"{uri} is no token file, or not a whole one")
        if head[len(MAGIC) + 1 :] != hashlib.sha256(content).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.kind = np.dtype(f"<u{head[len(MAGIC)]}")
        self.file.seek(at)
        self.index = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.file.read(size)), _INDEX)
        self.expand = zstandard.ZstdDecompressor(dict_data=loaded(content))

    def ids(self, position: int) -> np.ndarray:
        """The ids of the document at ``position`` of the index."""
        row = self.index[position]
        self.file.seek(int(row["offset"]))
        return np.frombuffer(self.expand.decompress(self.file.read(int(row["size"]))), self.kind)


MANIFEST = "part int, number int, file string, n_docs bigint, n_ids bigint"


def write_token_files(docs: DataFrame, folder: str, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the files and the dictionary; returns the manifest, itself a written table."""
    spark = docs.sparkSession
    small_batches(spark)
    content = dictionary(docs, path)
    with create(f"{folder}/dictionary.zdict") as out:
        out.write(content)
    held = spark.sparkContext.broadcast(content)
    width = id_type(path).itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, file = TaskContext.get().partitionId(), [], None
        for rows in blocks(batches, "text", BLOCK_BYTES):
            ids = encoded(rows.column("text"), path)
            for doc_id, own in zip(rows.column("doc_id").to_pylist(), ids, strict=True):
                if file is None:
                    file = Writer(f"{folder}/ids-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.tok", held.value, width)
                file.add(doc_id, own)
                if file.at >= file_bytes:
                    done.append(file.close())
                    file = None
        if file is not None:
            done.append(file.close())
        if done:
            names, n_docs, n_ids = zip(*done, strict=True)
            cols = [[part] * len(done), list(range(len(done))), names, n_docs, n_ids]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "number", "file", "n_docs", "n_ids"]
            )

    tie = F.xxhash64("text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", tie)
    ordered = rows.repartitionByRange(parts(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    return written(ordered.select("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")


READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, from the files."""
    spark = manifest.sparkSession
    # one row per file: the running sum over files is small
    before = F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(before, F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content = None
        for batch in batches:
            for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                if content is None:
                    content = open_seekable(f"{folder}/dictionary.zdict").read()
                reader = Reader(uri, content)
                index = reader.index
                sums = [zlib.crc32(reader.ids(i).astype("<u4").tobytes()) for i in range(len(index))]
                n = index["n"].astype(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(index["doc_id"].astype(np.int64), mask=index["known"] == 0),
                        pa.array(base + np.cumsum(n) - n), pa.array(n), pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.repartition(parts(spark), "file").mapInArrow(read, READ)


def op7_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(TOKENIZER))
    return read_token_files(manifest, folder)
