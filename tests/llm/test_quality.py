import math
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm.common import table
from starloom.llm.quality import ORDER, base_failed, judged, keep_good, score, scored, train


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


class Model:
    """Interpolated modified Kneser-Ney over the characters of words, by the book."""

    def __init__(self, texts):
        raw = Counter()
        for t in texts:
            for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""):
                padded = "\2" * (ORDER - 1) + w + "\3"
                raw.update(padded[i : i + ORDER] for i in range(len(padded) - ORDER + 1))
        self.adj = {ORDER: raw}
        total = raw
        for k in range(ORDER - 1, 0, -1):
            left, below = defaultdict(set), Counter()
            for g, n in total.items():
                left[g[1:]].add(g[0])
                below[g[1:]] += n
            self.adj[k] = {g: below[g] if g[0] == "\2" else len(left[g]) for g in below}
            total = below
        self.kinds = len(self.adj[1]) + 1
        self.d, self.ctx = {}, {}
        for k, grams in self.adj.items():
            n = Counter(min(a, 5) for a in grams.values())
            if all(n[i] for i in (1, 2, 3, 4)):
                y = n[1] / (n[1] + 2 * n[2])
                d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
            else:
                d = [0.5, 1.0, 1.5]
            self.d[k] = [min(max(x, 0), i + 1) for i, x in enumerate(d)]
            self.ctx[k] = defaultdict(lambda: [0, 0.0])
            for g, a in grams.items():
                self.ctx[k][g[:-1]][0] += a
                self.ctx[k][g[:-1]][1] += self.d[k][min(a, 3) - 1]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / self.kinds
        lower = self.p(g[1:])
        if g[:-1] not in self.ctx[k]:
            return lower
        total, held = self.ctx[k][g[:-1]]
        a = self.adj[k].get(g, 0)
        return (a - self.d[k][min(a, 3) - 1] if a else 0) / total + held / total * lower

    def surprise(self, text):
        logs = []
        for w in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            padded = "\2" * (ORDER - 1) + w + "\3"
            logs += [math.log(self.p(padded[i : i + ORDER])) for i in range(len(padded) - ORDER + 1)]
        return -sum(logs) / len(logs) if logs else None


@pytest.mark.parametrize("shard_rows", [5_000, 4_000_000])
def test_scores_equal_the_textbook_model(spark, tables, shard_rows):
    docs = table(spark, tables, "documents")
    rows = docs.collect()
    models = {lang: Model(r.text for r in rows if r.lang == lang) for lang in {r.lang for r in rows}}
    got = scored(docs, train(docs), shard_rows).select("doc_id", score().alias("s")).collect()
    got = {r.doc_id: r.s for r in got}
    for r in rows[:60]:
        assert got[r.doc_id] == pytest.approx(models[r.lang].surprise(r.text), abs=1e-4)


def test_base_measures(spark, tables, odd):
    docs = table(spark, tables, "documents").select("doc_id", "text", "lang")
    extra = odd.where("doc_id is not null").select("doc_id", "text", "lang").dropDuplicates(["doc_id"])
    both = docs.where("doc_id > 9").union(extra)
    got = {r.doc_id: r for r in judged(both).collect()}
    for r in both.collect():
        x = got[r.doc_id]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == base(r.text)
        assert not (x.base_failed and x.kept)


def test_noise_leaves_the_band_and_prose_does_not(spark, tables):
    docs = table(spark, tables, "documents").select("doc_id", "text", "lang")
    noise = spark.createDataFrame([(-1, "qzxj vkqw jjxz wqkv zzqj xkcd qpwz vvkj kqxz jwqv " * 3 + " ".join(f"zq{i}xk" for i in range(60)), "en")],
                                  "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in judged(docs.union(noise)).collect()}
    assert not got[-1].kept and got[-1].log_perplexity > got[-1].upper
    judged_on = [r for i, r in got.items() if i >= 0 and not r.base_failed]
    assert sum(r.kept for r in judged_on) >= 0.97 * len(judged_on)


def test_the_band_rejects_bad_texts_that_pass_the_base_rules(spark, tables):
    docs = table(spark, tables, "documents")
    quality = {r.doc_id: r.quality for r in table(spark, tables, "labels").collect()}
    out = [quality.get(r.doc_id) for r in judged(docs).where("not base_failed and not kept").collect()]
    assert out.count(0) >= 2 and out.count(1) == 0


def test_odd_rows(spark, odd, none):
    out = judged(odd)
    assert out.count() == odd.count() and out.where("doc_id = 3").first().base_failed
    assert out.where("doc_id = 2").count() == 2
    assert judged(none).count() == 0 and keep_good(spark, none, "").columns == none.columns
    assert keep_good(spark, odd, "").columns == odd.columns


def test_shards_change_no_rows(spark, odd):
    extra = [(None, "same size one of two texts", "en"), (None, "same size two of one texts", "en"), (None, "same size one of two texts", "en")]
    docs = odd.select("doc_id", "text", "lang").union(spark.createDataFrame(extra, "doc_id bigint, text string, lang string"))
    model = train(docs)
    one, many = (scored(docs, model, n).collect() for n in (4_000_000, 20))
    assert len(many) == len(one) == docs.count()
    exact = lambda rows: sorted((str(r[:-2]) for r in rows))
    assert exact(many) == exact(one)
    near = lambda rows: sorted((str(r[:-2]), r.surprise) for r in rows)
    assert all(abs(a[1] - b[1]) <= 64 for a, b in zip(near(many), near(one), strict=True))
