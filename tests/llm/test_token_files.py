import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from starloom.llm import token_files
from starloom.llm.common import table
from starloom.llm.files import open_seekable
from starloom.llm.token_files import END, TOKENIZER, Reader, encoded, read_token_files, tokenizer, write_token_files

PATH = public_tokenizers.path(TOKENIZER)


def ids_of(text):
    return tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + [END]


def expected(rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(t)
        out.append((str(i), at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def stored(docs, folder, **options):
    manifest = write_token_files(docs, folder, PATH, **options)
    return manifest, sorted(((str(a), *b) for a, *b in read_token_files(manifest, folder).collect()), key=lambda r: r[1])


def test_files_hold_every_document_in_order(spark, tables, tmp_path):
    docs = table(spark, tables, "documents")
    manifest, got = stored(docs, str(tmp_path), file_bytes=20_000)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])
    file = manifest.orderBy("part", "number").first()["file"]
    content = open_seekable(f"{tmp_path}/dictionary.zdict").read()
    reader, texts = Reader(file, content), {r.doc_id: r.text for r in docs.collect()}
    for k in (len(reader.index) - 1, 0):  # any document, without those before it
        assert reader.ids(k).tolist() == ids_of(texts[int(reader.index[k]["doc_id"])])
    with pytest.raises(ValueError):
        Reader(file, content + b"x")


def test_odd_rows(spark, odd, none, tmp_path):
    _, got = stored(odd, str(tmp_path / "odd"))
    want = expected([(r.doc_id, r.text) for r in odd.collect()])
    assert got == want
    assert stored(none, str(tmp_path / "none"))[1] == []


@pytest.mark.parametrize("text", ["", " ", "a  b", "\n a \n\nb ", "a <|endoftext|> b<|endoftext|>", "it's 1 2\u00a0 3\u2003x", "x\x1cy \x1d z"])
def test_words_encode_like_the_whole_text(text):
    assert np.frombuffer(encoded([text], PATH)[0], "<u2").tolist() == ids_of(text)


def test_pieces_encode_like_the_whole_text():
    bits = ["a", "Z", "\u00e9", "\u00df", "\u00d7", "\u00aa", " ", "  ", "\n", "\n\n", "\t", "\r", ".", "'", "'s", "<|endoftext|>", "<|", "3", "\u0663"]
    bits += ["\u00a0", "\u0085", "\u2003", "\u2014", "\u3000", "\u4e2d", "\u044f", "\u0301", "\x1c", "\x7f", "\x00", "_", "\U0001f600"]
    dealt = random.Random(7)
    texts = ["".join(dealt.choices(bits, k=dealt.randrange(12))) for _ in range(5000)] + [None, ""]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoded(texts, PATH)] == [ids_of(t) for t in texts]


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_WORDS", 5)
    token_files._remembered.cache_clear()
    first = encoded(["The word. A word, the word!\nword (word)"], PATH)
    lately, _ = token_files._remembered(PATH)
    assert {" word", "word", " the"} <= set(lately) and not {" word.", " word,", " word!\nword"} & set(lately)
    encoded(["some other words"], PATH)  # more than are remembered: the pieces move on, used ones come back
    assert encoded(["The word. A word, the word!\nword (word)"], PATH) == first
    token_files._remembered.cache_clear()
