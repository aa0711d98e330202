import hashlib
import random
import re
import zlib

import pytest

from starloom.llm.common import table, written
from starloom.llm.repair import VECTORS, back, chunks, linked, op13_conversation_repair, repair_report, settled, vectors_in_front, with_repeats

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def brute_one(rows):
    """One conversation's report, by keeping the least (cost, audit) for every string of role letters' state."""
    digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))
    turns = [r[1] for r in rows if r[1] is not None]
    faults = dict(blank=0, duplicate=0, truncated=0)
    seen, kinds = set(), []
    for _, _, role, text in rows:
        filled = BLANK.findall(text)
        kind = "blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else None
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            faults[kind] += 1
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def offer(found, state, cost, audit, said):
        if state not in found or (cost, audit) < found[state][:2]:
            found[state] = (cost, audit, said)

    def insert(found):
        for _ in range(4):
            for state, (cost, audit, said) in list(found.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in step:
                        offer(found, role[0], cost + 5, audit + "I", (*said, (role, "")))
        return found

    for (_, _, role, text), kind in zip(rows, kinds, strict=True):
        found = {}
        for state, (cost, audit, said) in insert(best).items():
            offer(found, state, cost + 2, audit + "D", said)
            if kind in ("blank", "duplicate"):
                continue
            more = 5 if kind == "truncated" else 0
            if (state, role[:1]) in step:
                offer(found, role[0], cost + more, audit + "K", (*said, (role, text)))
            for other in ("user", "assistant"):
                if (state, other[0]) in step:
                    offer(found, other[0], cost + more + 1, audit + "R", (*said, (other, text)))
        best = found
    cost, audit, said = min(v for s, v in insert(best).items() if s in ("", "a"))
    letters = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    body = "\n".join(f"{r}:{t}" for r, t in said)
    return gaps, *faults.values(), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()


def brute(original, rows):
    by_conv = {r[0]: [] for r in original}
    for r in rows:
        by_conv[r[0]].append(r)
    return {(c, *brute_one(rs)) for c, rs in by_conv.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_equals_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversation_repair(spark, folder)
    kinds = {c: "bigint" for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    assert dict(got.dtypes) == kinds | {"audit": "string", "repaired_sha256": "string"}
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows, brute_damage(rows))


def logs(seed, sizes, roles=("user", "assistant", "system", "tool", "", " ")):
    draw, rows = random.Random(seed), []
    for conv, n in enumerate(sizes):
        for i in range(n):
            text = draw.choice(["", " \t", "ok.", "no", "why?", f"text {i}.", f"cut {i}", f"say {draw.randint(0, 30)}!"])
            weights = [6, 6] + [1] * (len(roles) - 2)
            rows.append((conv, draw.choice([i, i, i, i // 2, None]), draw.choices(roles, weights)[0], text))
    return rows


@pytest.mark.parametrize(("seed", "chunk_rows", "ranges"), [(1, 4096, 1), (2, 1, 3), (3, 2, 7), (4, 5, 4), (5, 3, 13)])
def test_conversations_in_any_chunks(spark, seed, chunk_rows, ranges):
    rows = logs(seed, [0, 1, 2, 3, 3, 5, 8, 13, 60, 150])
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = repair_report(frame, frame, chunk_rows=chunk_rows, ranges=ranges)
    assert {tuple(r) for r in got.collect()} == brute(rows, rows)


def test_chunks_that_never_run_together(spark):
    """Only system turns: vectors keep their differences from the end to the front."""
    rows = [(1, i, "system", f"note {i}.") for i in range(101)] + [(2, i, "system", f"note {i}.") for i in range(100)]
    rows += [(3, i, "user" if i % 2 else "assistant", f"say {i}.") for i in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA)
    cut = written(chunks(frame, chunk_rows=4, ranges=5), "c")
    split = written(with_repeats(cut, written(linked(cut), "l")), "s")
    ways = {r.key: set() for r in split.collect()}
    for r in vectors_in_front(split).collect():
        ways[r.key].add(len(set(r.way)))
    assert min(ways["=1"]) > 1 and 1 in ways["=3"]
    got = repair_report(frame, frame, chunk_rows=4, ranges=5)
    assert {tuple(r) for r in got.collect()} == brute(rows, rows)


def test_one_row_repeated_over_many_chunks(spark):
    rows = [(7, 1, "user", "same words.")] * 200 + [(7, 2, "assistant", "yes.")] * 100 + [(None, None, None, None)] * 30
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = repair_report(frame, frame, chunk_rows=7, ranges=9)
    assert {tuple(r) for r in got.collect()} == brute(rows, [(c, t, r or " ", x or " ") for c, t, r, x in rows])


def test_settling_equals_walking(spark):
    """Ways that stay open through long stretches, against a walk from end to end."""
    draw = random.Random(3)
    rows, want = [], {}
    for key in range(12):
        n = draw.randint(1, 70)
        ways = [draw.choice([[0, 1, 2, 3], [1, 0, 3, 2], [2, 2, 2, 2] if draw.random() < 0.1 else [3, 2, 1, 0]]) for _ in range(n)]
        rows += [(str(key), i + 1, n, w) for i, w in enumerate(ways)]
        for step in (1, -1):
            now = 1
            for i in (range(n - 1, -1, -1) if step > 0 else range(n)):
                now = ways[i][now]
                want[str(key), i + 1, step] = now
    frame = spark.createDataFrame(rows, "key string, place bigint, n_chunks bigint, way array<int>")
    for step in (1, -1):
        got = {(r.key, r.place, step): r.out for r in settled(frame, step, 1).collect()}
        assert got == {k: v for k, v in want.items() if k[2] == step}


def test_vectors_are_closed():
    from starloom.llm.repair import ROWS

    assert {back(v, r) for v in VECTORS for r in ROWS} <= set(VECTORS) and len(VECTORS) < 50


def test_odd_rows(spark):
    rows = [(1, 0, "user", "x" * 500_000 + "."), (1, 1, "assistant", "y."), (2, None, None, "a."), (2, 3, "user", None), (None, 1, "user", "b?")]
    rows += [(None, 1, "user", "b?"), (5, 9, "assistant", " ")]
    frame = spark.createDataFrame([(*r, 9, "k") for r in rows], SCHEMA + ", place int, key string")
    got = repair_report(frame, frame, chunk_chars=1000)
    assert {tuple(r) for r in got.collect()} == brute(rows, [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows])
    gone = repair_report(frame, frame.where("false")).collect()
    assert {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())} and len(gone) == 4
    assert repair_report(frame.where("false"), frame.where("false")).count() == 0
