import random
import re

from starloom.llm.common import table
from starloom.llm.passages import repeats, units, without_repeats

SCHEMA = "doc_id bigint, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_units(text):
    """Word by word."""
    out, line = [], 0
    for part in text.split("\n"):
        held = []
        for m in WORD.finditer(part):
            held.append(m)
            if m.group()[-1] in ".,;:!?":
                out.append((line + held[0].start(), [h.group().lower() for h in held]))
                held = []
        if held:
            out.append((line + held[0].start(), [h.group().lower() for h in held]))
        line += len(part) + 1
    return out


def brute(rows, min_words, start_words):
    """What is left of each text, and the spans removed."""
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        found, gone, spans = brute_units(text or ""), set(), []
        for i, (start, words) in enumerate(found):
            said, j = [], i
            while j < len(found) and len(said) < min_words:
                said += found[j][1]
                j += 1
            if len(said) < min_words or len(words) < start_words:
                continue
            kept = first.setdefault(tuple(said), (doc, start))
            if kept != (doc, start):
                if spans and i in gone or spans and i - 1 in gone:
                    spans[-1][1] = max(spans[-1][1], j)
                else:
                    spans.append([i, j, kept])
                gone |= set(range(i, j))
        starts = [s for s, _ in found] + [len(text or "")]
        cut = [(starts[i], starts[j], *kept) for i, j, kept in spans]
        left, at = "", 0
        for s, e, *_ in cut:
            left, at = left + text[at:s], e
        out[doc] = (None if text is None else left + text[at:], cut)
    return out


def check(spark, rows, min_words, start_words):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r.doc_id: (r.text, [tuple(x) for x in r.removed]) for r in without_repeats(docs, min_words, start_words).collect()}
    want = brute(rows, min_words, start_words)
    assert got == want
    return want


def test_given_documents(spark, tables):
    rows = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    assert any(cut for _, cut in check(spark, rows, 25, 4).values())


def test_crowded_texts(spark):
    draw = random.Random(6)
    pool = ["one two, ", "three four five. ", "six\n", "seven eight nine ten; ", "a b c d e f\n", "x, ", "a.b c:d e ", "\n\n"]
    rows = [(i, "".join(draw.choices(pool, k=draw.randint(0, 40)))) for i in range(60)]
    for min_words, start_words in ((5, 1), (12, 3), (25, 4)):
        want = check(spark, rows, min_words, start_words)
        assert min_words > 5 or any(cut for _, cut in want.values())
    assert all(units(t) == brute_units(t) for _, t in rows)


def test_a_passage_inside_a_line_is_found(spark):
    draw = random.Random(1)
    words = lambda n: " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))
    passage = ". ".join(words(9) for _ in range(6)) + "."
    lines = "Copyright by nobody, all rights kept"
    rows = [(i, f"{words(20)}. {words(7)}, {passage if i % 2 else words(40)} {words(12)}\n{lines}\n{words(30)}") for i in range(8)]
    got = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, text in rows:
        assert lines in got[i].text
        if i % 2 == 0 or i == 1:
            assert got[i].text == text and got[i].removed == []
        else:
            assert passage not in got[i].text and got[i].text == text.replace(passage + " ", "")
            assert [(x.start, x.end) for x in got[i].removed] == [(text.index(passage), text.index(passage) + len(passage) + 1)]
            assert got[i].removed[0].kept_doc_id == 1


def test_units_are_normalised_and_offsets_kept(spark):
    rows = [(1, "Short\nThis line has  five Words\nend"), (2, "é中\n  this LINE has five\twords \nShort"), (3, "this line has five words")]
    out = {r.doc_id: r for r in without_repeats(spark.createDataFrame(rows, SCHEMA), 5, 1).collect()}
    assert out[1].text == rows[0][1] and out[1].removed == []
    assert out[2].text == "é中\n  Short" and [tuple(x) for x in out[2].removed] == [(5, rows[1][1].index("Short"), 1, 6)]
    assert out[3].text == ""


def test_odd_rows(spark, odd, none):
    out = without_repeats(odd, 5, 1)
    assert out.columns == [c for c in odd.columns if c != "removed"] + ["removed"]
    rows = {}
    for r in out.collect():
        rows.setdefault(str(r.doc_id), []).append(r)
    assert sum(map(len, rows.values())) == odd.count()
    assert len(rows["2"]) == 2 and all(r.text == "" for r in rows["2"]) and rows["1"][0].removed == []
    assert rows["3"][0].text is None and rows["4"][0].text == "" and rows["6"][0].text == "one" == rows["7"][0].text
    assert without_repeats(none).count() == 0 and repeats(none).count() == 0
