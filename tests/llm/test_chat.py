from collections import defaultdict

from starloom.llm.chat import END, START, formatted

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, key string"


def expected(rows):
    """Conversations that are no proper prefix of another; of equal ones the first; rendered whole."""
    whole = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        whole[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: tuple(x[2:] for x in sorted(v)) for c, v in whole.items()}
    out = {}
    for c, t in turns.items():
        longer = any(len(o) > len(t) and o[: len(t)] == t for o in turns.values())
        equal = [k for k, o in turns.items() if o == t]
        first = min((k for k in equal if k is not None), default=None)
        if not longer and c == first:
            out[c] = "".join(f"{START}{r}\n{x}{END}\n" for r, x in t)
    return out


def collected(frame):
    parts = defaultdict(dict)
    for r in frame.collect():
        parts[r.conv_id][r.part] = r.text
    return {c: "".join(p[k] for k in sorted(p)) for c, p in parts.items()}


def test_prefixes_go_and_the_rest_is_rendered_whole(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}", 9, "x") for k in range(2)]
    rows += [(2, k, "user" if k % 2 == 0 else "assistant", f"t{k}", 9, "x") for k in range(300)]  # holds most rows
    rows += [(3, k, "user" if k % 2 == 0 else "assistant", f"t{k}", 9, "x") for k in range(300)]  # equal to 2
    rows += [(4, 0, "user", "t0", 9, "x"), (4, 1, "assistant", "other", 9, "x")]
    rows += [(5, 7, None, None, 9, "x"), (6, None, "user", "", 9, "x"), (None, 0, "user", "unnamed", 9, "x")]
    rows += [(7, 0, "user", "twice", 9, "x")] * 2 + [(8, 0, "user", "twice", 9, "x")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(formatted(frame)) == expected(rows)


def test_no_rows_make_no_conversations(spark):
    assert formatted(spark.createDataFrame([], SCHEMA)).count() == 0
