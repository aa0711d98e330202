import re
import zlib
from collections import Counter

import pytest

from starloom.llm.common import table, written
from starloom.llm.variants import counted_words, grouped, near_pairs, op11_spelling_variants

DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, slip=199, least=6, often=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(DOWN)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % slip == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def brute_near(words):
    """Neighbours by trying every edit."""
    letters = sorted(set("".join(words)))
    near = {w: set() for w in words}
    for w in words:
        for k in range(len(w) + 1):
            tries = {w[:k] + w[k + 1 :]} if k < len(w) else set()
            tries |= {w[:k] + c + w[k:] for c in letters} | ({w[:k] + c + w[k + 1 :] for c in letters} if k < len(w) else set())
            near[w] |= {t for t in tries if t != w and t in near}
    return near


def brute(words):
    near = brute_near(words)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_equals_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    got = op11_spelling_variants(spark, folder)
    assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(brute_words(rows))


def test_all_kinds_of_edits_on_a_dense_vocabulary(spark):
    """Words over few letters, where nearly all are near something and signatures are crowded."""
    import itertools

    words = {"".join(p): 1 + hash_ % 97 for hash_, p in enumerate(itertools.product("abé", repeat=6))}
    words |= {"".join(p): 5 + k % 301 for k, p in enumerate(itertools.product("ab", repeat=7))}
    words |= {"ab" * 300: 3, "ab" * 300 + "a": 15, "ab" * 299 + "b": 75}
    got = grouped(written(spark.createDataFrame(list(words.items()), "word string, n bigint"), "t"))
    assert {tuple(r) for r in got.collect()} == brute(words)


def test_chains_ties_and_no_neighbours(spark):
    words = {"abcdef": 1, "abcdefg": 5, "abcdefgh": 25, "abcdefghi": 125, "zzzzzz": 9, "zzzzzy": 45, "zzzzzx": 45, "lonely": 7}
    got = {r.word: r for r in grouped(written(spark.createDataFrame(list(words.items()), "word string, n bigint"), "t")).collect()}
    assert got["abcdef"].root == "abcdefghi" and got["abcdef"].form == "abcdefg" and got["abcdef"].form_n == 5
    assert got["zzzzzz"].form == "zzzzzx" and got["zzzzzx"].form is None and got["zzzzzx"].root == "zzzzzx"
    assert (got["lonely"].n_near, got["lonely"].form, got["lonely"].root) == (0, None, "lonely")


def test_pairs_come_once(spark):
    rows = [("aaaaaa", 1), ("aaaaab", 2), ("aaaaaab", 3)]
    pairs = near_pairs(written(spark.createDataFrame(rows, "word string, n bigint"), "t")).collect()
    assert sorted((p.a, p.an, p.b, p.bn) for p in pairs) == [
        ("aaaaaa", 1, "aaaaaab", 3), ("aaaaaa", 1, "aaaaab", 2), ("aaaaaab", 3, "aaaaab", 2)
    ]


def test_odd_rows(spark, odd, none):
    got = {r.word: r.n for r in counted_words(odd, min_count=1, min_length=1).collect()}
    want = brute_words([(r.doc_id, r.text) for r in odd.collect()], least=1, often=1)
    assert got == want and "x" * 50_000 in got or "x" * 49_999 in got
    assert grouped(written(counted_words(none), "t")).count() == 0
