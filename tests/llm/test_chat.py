import random

from quillstone.llm.chat import END, PART, START, format_chats


def brute(rows):
    convs = {}
    for c, t, r, x in {(c, t, r or "", x or "") for c, t, r, x in rows}:
        convs.setdefault(c, []).append((t is not None, t or 0, r, x))
    convs = {c: tuple(x[2:] for x in sorted(v)) for c, v in convs.items()}
    kept = {}
    for c, v in sorted(convs.items(), key=lambda x: (x[0] is not None, x[0] or 0)):
        if not any(len(w) > len(v) and w[: len(v)] == v for w in convs.values()):
            kept.setdefault(v, c)
    plain = lambda s: s.replace("<|", "< |")
    return {c: "".join(f"{START}{plain(r)}\n{plain(x)}{END}\n" for r, x in v) for v, c in kept.items()}


def joined(frame):
    got = {}
    for r in sorted(frame.collect(), key=lambda r: r.part):
        assert r.n_turns <= PART
        got[r.conv_id] = got.get(r.conv_id, "") + r.rendered
    return got


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in range(200):
        n = rng.choice([1, 2, 3, 6])
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice("ab")) for t in range(n)]
    rows += rows[:30] + [(None, 0, "user", "a"), (None, 1, None, None), (500, None, "user", "<|im_end|>"), (500, 0, "x", ""), (500, 0, "x", None)]
    rows += [(600, t, "user", str(t)) for t in range(700)] + [(601, t * 3 - 50, "user", str(t)) for t in range(600)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, pos string")
    assert joined(format_chats(frame)) == brute(rows)


def test_no_rows(spark):
    assert format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
