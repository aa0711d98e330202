import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from starloom.llm.byte_bpe import RANKS, coded_digests, encode_and_decode, encoder, from_planes, planes, words_of
from starloom.llm.common import table

PATH = public_tokenizers.path(RANKS)


def test_ids_are_the_librarys_and_decode_to_the_text(spark, tables, odd):
    docs = table(spark, tables, "documents").select("doc_id", "text").union(odd.select("doc_id", "text").where("doc_id is null or doc_id > 2"))
    want = sorted((str(r.doc_id), tuple(encoder(PATH).encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.collect())
    got = sorted((str(r.doc_id), tuple(np.frombuffer(r.ids, "<u4").tolist()), bytes(r.decoded)) for r in encode_and_decode(docs, PATH).collect())
    assert got == want


def test_odd_rows(odd, none):
    got = coded_digests(odd)
    assert got.count() == odd.count() and coded_digests(none).count() == 0
    assert got.where("doc_id in (3, 4)").select("n_tokens").distinct().collect()[0][0] == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'ts1 \n\t\u00a0\u2003\x1c\x85.,é漢"), max_size=40))
def test_words_never_share_a_pre_token(text):
    words = words_of(text)
    assert "".join(words) == text
    assert [i for w in words for i in encoder(PATH).encode_ordinary(w)] == encoder(PATH).encode_ordinary(text)


def test_planes_round_trip():
    values = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], np.uint32)
    assert from_planes(planes(values), 6).tolist() == values.tolist()
