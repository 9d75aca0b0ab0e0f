import hashlib
import math
import random
import re
import time
from collections import defaultdict

from quillstone.llm.pii import CONTEXT, FEATURES, KINDS, ROUNDS, VOTES, _fit, _found, find_personal_data
from tests.llm.cases import CLASH, docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            s, d = m.group(), re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
                "card": lambda: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda: 8 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


HAND = [
    None, "", "a@b.c", "a@b.com_x@c.de", "x@@y.z a@b@c.de", "..@a.b.c-", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.001.1.0000256", "00000000255.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 1", "4111  1111 1111 1111", "41111111111111111111", "é😀 +1 (555) 555-0100 ü a@b.co",
    "+12345678 +1234567 +1-2", "++1 23456789", "call 555-123-4567 now", "mail me: joe (at) example (dot) com", "9" * 20000, "1.1." * 5000, "a." * 5000 + "@" + "b." * 5000 + "c",
    "4111111111111111-4111111111111111", "+1 2345678 +1 2345678",
]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(6)
    tokens = ["4111111111111111", "4111 1111 1111 1111", "a@b.co", "192.168.1.1", "+1 (555) 555-0100", "@", ".", "-", " ", "5", "é", "😀", "(", ")", "12", "x_y", "%", "+", "\n", "300"]
    texts = HAND + ["".join(rng.choices(tokens, k=rng.randint(1, 25))) for _ in range(1500)]
    got = {r.doc_id: r for r in find_personal_data(docs(spark, texts, schema=CLASH).repartition(4)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, r = brute(t), got[i]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(w.startswith(k + ":") for w in want) for k in KINDS], t
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and len(set(spans)) == len(spans)
        key = lambda s: (KINDS.index(s.split(":")[0]), int(s.split(":")[1]))
        assert spans == sorted(spans, key=key)


def test_the_method_adds_wide_forms_in_context(spark):
    texts = ["tel 555-223-4567 and more", "mail joe(at)example(dot)com please"] * 20 + ["mail x@example.com", "ip 10.1.2.3 host"] * 5
    rows = find_personal_data(docs(spark, texts)).collect()
    assert any("phone:" in r.spans for r in rows) and any("email:5:" in r.spans and r.n_email == 0 for r in rows)


def test_null_ids_repeats_and_no_rows(spark):
    rows = find_personal_data(docs(spark, ["a@b.co", "a@b.co", None], [1, 1, None])).collect()
    assert sorted(map(str, ((r.doc_id, r.spans) for r in rows))) == ["(1, 'email:0:6')", "(1, 'email:0:6')", "(None, '')"]
    assert find_personal_data(docs(spark, [])).count() == 0


def test_matches_and_what_stands_before_them(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    pattern = r"\+[0-9][\x20().0-9-]+[0-9]"
    texts = ["".join(rng.choices(["+123", "é", "😀", "+1 (2) 34", "word ", "\n", "+"], k=rng.choice([1, 5, 40, 300]))) for _ in range(200)]
    rows = docs(spark, texts + [""]).select("text", _found(F.col("text"), pattern, r"\+[0-9]").alias("x")).collect()
    for r in rows:
        want = [(m.start(), m.end(), m.group(), r.text[max(0, m.start() - CONTEXT) : m.start()]) for m in re.finditer(pattern, r.text)]
        assert [tuple(x) for x in r.x] == want
    assert max(len(r.x) for r in rows) > 60


def test_wide_forms_that_overlap_base_spans_are_left_out(spark):
    text = "tel 555-223-4567 mail joe(at)example(dot)com " * 30 + "call +1 555-223-4567 tel 555-223-4567 "
    (row,) = find_personal_data(docs(spark, [text])).collect()
    spans = [(k, int(lo), int(hi)) for k, lo, hi in (x.split(":") for x in row.spans.split(","))]
    for a in spans:
        assert not any(a is not b and a[0] == b[0] and a[1] < b[2] and b[1] < a[2] for b in spans)
    assert row.n_phone == 1 and sum(k == "phone" for k, _, _ in spans) == 32


def test_a_text_of_very_many_spans(spark):
    """30,000 spans of base and wide form in one text: minutes, if each cost a walk over the text or its other spans."""
    text = "mail a@b.co or tel 555-223-4567, " * 15_000
    began = time.time()
    (row,) = find_personal_data(docs(spark, [text])).collect()
    assert row.n_email == 15_000 and row.base_sha256 == hashlib.sha256(",".join(brute(text)).encode()).hexdigest()
    assert row.spans.count("phone:") in (0, 15_000) and time.time() - began < 60


def plain_fit(rows):
    """Expectation-maximisation and the classifier's weights, row by row."""
    prior = dict.fromkeys(range(4), 0.5)
    right, wrong = defaultdict(lambda: 0.8), defaultdict(lambda: 0.8)

    def posterior(r):
        yes, no = prior[r["kind"]], 1 - prior[r["kind"]]
        for v in VOTES:
            a, b = right[r["kind"], v], wrong[r["kind"], v]
            if r[v]:
                yes, no = yes * (a if r[v] == 1 else 1 - a), no * (1 - b if r[v] == 1 else b)
        return yes / (yes + no)

    for _ in range(ROUNDS):
        p = [posterior(r) for r in rows]
        for k in {r["kind"] for r in rows}:
            own = [(r, q, r["n"]) for r, q in zip(rows, p) if r["kind"] == k]
            prior[k] = (sum(q * n for _, q, n in own) + 1) / (sum(n for _, _, n in own) + 2)
            for v in VOTES:
                hit, of = (sum(q * n for r, q, n in own if test(r[v])) for test in (lambda x: x == 1, lambda x: x != 0))
                miss, off = (sum((1 - q) * n for r, q, n in own if test(r[v])) for test in (lambda x: x == -1, lambda x: x != 0))
                right[k, v] = min(0.99, max(0.5, (hit + 4) / (of + 5)))
                wrong[k, v] = min(0.99, max(0.5, (miss + 4) / (off + 5)))
    p, weights = [posterior(r) for r in rows], []
    for k in range(4):
        own = [(r, q, r["n"]) for r, q in zip(rows, p) if r["kind"] == k]
        yes, no = sum(q * n for _, q, n in own), sum((1 - q) * n for _, q, n in own)
        weights.append([math.log((yes + 1) / (no + 1))])
        for f in FEATURES:
            a = (sum(q * n for r, q, n in own if r[f]) + 1) / (yes + 2)
            b = (sum((1 - q) * n for r, q, n in own if r[f]) + 1) / (no + 2)
            weights[-1] += [math.log((1 - a) / (1 - b)), math.log(a / b)]
    return weights


def test_reliabilities_and_weights_equal_a_plain_version(spark):
    rng = random.Random(9)
    rows = [
        {"kind": rng.randrange(3), **{v: rng.choice([-1, 0, 1]) for v in VOTES}, **{f: rng.randrange(2) for f in FEATURES}, "n": rng.choice([1, 7, 900])}
        for _ in range(400)
    ]
    schema = ", ".join(f"{c} int" for c in ["kind", *VOTES, *FEATURES]) + ", n long"
    got = _fit(spark.createDataFrame([tuple(r.values()) for r in rows], schema))
    for a, b in zip(got, plain_fit(rows)):
        assert len(a) == len(b) and all(abs(x - y) < 1e-9 for x, y in zip(a, b))
