import re
from itertools import combinations

import numpy as np
import pytest

from starloom.llm.common import table
from starloom.llm.jaccard import linked_classes, minhashes, one_of_each, plan_bands, shingle_sets
from starloom.llm import jaccard


def brute(rows):
    """Links and classes from all pairs of rows with an id."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append(s if i is not None else set())
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if sets[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), str(least[find(k)] if sets[k] else i), links[k]) for k, (i, _) in enumerate(rows))


def got(frame):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in frame.collect())


def test_all_links_and_classes(spark, tables):
    docs = table(spark, tables, "documents")
    assert got(linked_classes(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_a_large_family_is_checked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    monkeypatch.setattr(jaccard.candidate_edges, "__defaults__", (8,))
    monkeypatch.setattr(jaccard.verified, "__defaults__", (8,))
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 5))):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[3][1]) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(linked_classes(frame)) == brute(rows)


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(linked_classes(odd)) == brute(rows)
    assert linked_classes(none).count() == 0
    left = one_of_each(spark, odd, "")
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "3", "4", "5", "6", "8", "9", "None"])


@pytest.mark.parametrize("recall", [0.9, 0.9999])
def test_bands_reach_the_recall(recall):
    bands, rows = plan_bands(0.8, recall, 256)
    assert bands * rows <= 256 and 1 - (1 - 0.8**rows) ** bands >= recall
    with pytest.raises(ValueError):
        plan_bands(0.01, 0.999999, 4)


def test_minhashes_estimate_similarity():
    a = " ".join(f"w{i}" for i in range(400))
    b = " ".join(f"w{i}" if i < 300 else f"v{i}" for i in range(400))
    hashes, bounds = shingle_sets([a, b])
    sig = minhashes(hashes, bounds, 512)
    assert abs((sig[0] == sig[1]).mean() - 296 / 496) < 0.1
