import hashlib

import public_tokenizers

import corpus_pipeline
from starloom.llm.byte_bpe import RANKS, encoder
from starloom.llm.common import table, written
from starloom.llm.decontaminate import leaks
from starloom.llm.jaccard import linked_classes
from starloom.llm.pii import pseudonymised
from starloom.llm.quality import judged


def test_stages_keep_their_promises(spark, tables):
    docs = table(spark, tables, "documents")
    items = table(spark, tables, "benchmark")
    ids = lambda frame: {r.doc_id for r in frame.collect()}
    wants = [
        lambda d: ids(judged(d).where("kept")),
        lambda d: {r.class_id for r in linked_classes(d).collect()},
        lambda d: ids(d) - ids(leaks(d, items)),
        ids,
        ids,
    ]
    for (name, stage), want in zip(corpus_pipeline.STAGES, wants, strict=True):
        out = written(stage(spark, docs, tables), name)
        assert ids(out) == want(docs) and out.count() == len(ids(out))
        if name != "byte_level_bpe":
            assert out.columns == docs.columns
        if name == "pii":
            new = {r.doc_id: r.text for r in pseudonymised(docs).collect()}
            assert all(r.text == new[r.doc_id] and r.n_chars == len(r.text) for r in out.collect())
        if name == "byte_level_bpe":
            one = encoder(public_tokenizers.path(RANKS))
            given = {r.doc_id: r.text for r in docs.collect()}
            for r in out.collect():
                ids_ = one.encode_ordinary(given[r.doc_id])
                assert r.n_tokens == len(ids_) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids_)).encode()).hexdigest()
        docs = out


def test_nothing_in_nothing_out(spark, none, tables):
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0
