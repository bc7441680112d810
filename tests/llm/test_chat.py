import random

from txnmill.llm.chat import formatted


def plain(rows):
    """(conv_id, turn, role, text) rows to {conv_id: (turns, copies, text)} of maximal conversations."""
    logged = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            logged.setdefault(conv, []).append((turn, role, text))

    def key(t):
        return (t[0] is None, t[0] or 0, t[1] is not None, t[1] or "", t[2] is not None, t[2] or "")

    talks = {c: tuple(t[1:] for t in sorted(ts, key=key)) for c, ts in logged.items()}
    heads = {t[:n] for t in talks.values() for n in range(1, len(t))}
    out = {}
    for c in sorted(talks):
        t = talks[c]
        if t in heads or any(talks[d] == t for d in out):
            continue
        text = "".join(f"<|im_start|>{'unknown' if r is None else r}\n{x or ''}<|im_end|>\n" for r, x in t)
        out[c] = (len(t), sum(talks[d] == t for d in talks), text)
    return out


def run(spark, rows, **options):
    frame = spark.createDataFrame(
        [(*r, "a", "b") for r in rows], "conv_id long, turn long, role string, text string, place string, part string"
    )
    out = {}
    for r in sorted(formatted(frame, **options).collect(), key=lambda r: (r.conv_id, r.part)):
        n, copies, text = out.get(r.conv_id, (r.n_turns, r.copies, ""))
        out[r.conv_id] = (n, copies, text + r.text)
    return out


def test_snapshots_collapse(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(0, 400, 10):
        talk = [(rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "tell me"])) for _ in range(rng.randint(1, 8))]
        for copy in range(rng.randint(1, 4)):
            length = rng.randint(1, len(talk))
            start = rng.choice([0, 1, 50])
            rows += [(conv + copy, start + 2 * i, *talk[i]) for i in range(length)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, part_turns=2) == plain(rows)


def test_one_long_and_many_equal_conversations(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(90)] + [(2, i, "user", f"t{i}") for i in range(40)]
    rows += [(100 + c, 0, "user", "same") for c in range(200)]
    assert run(spark, rows, part_turns=16) == plain(rows)


def test_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "a"), (2, 0, "user", None), (3, 0, "user", ""), (4, 0, None, "a"),
            (4, 0, None, "a"), (5, None, "user", "late"), (5, 0, "user", None), (5, 0, "user", "b"), (6, 7, "user", "x" * 20000),
            (7, 0, "a", None), (8, 0, None, "a"), (None, 0, "user", "lost"), (9, -5, "user", "")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, part_turns=1) == plain(rows)
    assert run(spark, rows[:0]) == {}


def test_no_python_in_the_plan(spark):
    frame = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = formatted(frame)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
