import random
import zlib
from collections import Counter

from quillstone.llm.sharding import _exchange, _pack, shard_documents
from tests.llm.cases import CLASH, docs


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards)) and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_groups_stay_together_and_counts_even(spark):
    rng = random.Random(4)
    texts = [f"single {i}" for i in range(500)] + [None, None, "", "é😀"]
    for g in range(40):
        texts += [f"group {g}"] * rng.randint(2, 9)
    rows = shard_documents(docs(spark, texts, schema=CLASH).repartition(4)).collect()
    check(rows, texts, 8)
    by = {}
    for r in rows:
        by.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sum(len(s) > 1 for s in by.values()) <= 2


def test_a_group_larger_than_a_shard(spark):
    texts = ["hot"] * 200 + [f"s{i}" for i in range(300)] + ["pair"] * 2
    rows = shard_documents(docs(spark, texts), shards=8).collect()
    check(rows, texts, 8)
    hot = Counter(r.shard for r in rows if texts[r.doc_id] == "hot")
    assert max(hot.values()) >= 55 and len({r.shard for r in rows if texts[r.doc_id] == "pair"}) == 1


def whole(rows, texts):
    """How many repeated texts have all their rows in one shard."""
    by = {}
    for r in rows:
        by.setdefault(texts[r.doc_id], []).append(r.shard)
    return sum(len(s) > 1 and len(set(s)) == 1 for s in by.values())


def test_rounds_go_on_until_few_single_texts_have_made_all_pairs_whole(spark):
    texts = [f"pair {g}" for g in range(4750)] * 2 + [f"single {i}" for i in range(500)]
    rows = shard_documents(docs(spark, texts), shards=8).collect()
    check(rows, texts, 8)
    assert whole(rows, texts) == 4750


def test_tables_without_single_texts(spark):
    for texts in ([f"pair {g}" for g in range(800)] * 2, [f"five {g}" for g in range(320)] * 5):
        rows = shard_documents(docs(spark, texts), shards=8).collect()
        check(rows, texts, 8)
        assert whole(rows, texts) == len(set(texts))


def test_groups_of_ten_beside_few_single_texts(spark):
    texts = [f"group {g}" for g in range(180)] * 10 + [f"single {i}" for i in range(200)]
    for rounds in (None, 0):
        rows = shard_documents(docs(spark, texts), shards=8, rounds=rounds).collect()
        check(rows, texts, 8)
        assert whole(rows, texts) == 180


def test_a_hot_group_beside_many_pairs(spark):
    texts = ["hot"] * 533 + [f"pair {g}" for g in range(320)] * 2 + [f"single {i}" for i in range(427)]
    rows = shard_documents(docs(spark, texts), shards=8).collect()
    check(rows, texts, 8)
    assert whole(rows, texts) == 320
    assert sorted(Counter(r.shard for r in rows if texts[r.doc_id] == "hot").values()) == [133, 200, 200]


def test_only_one_text(spark):
    texts = ["hot"] * 19
    check(shard_documents(docs(spark, texts), shards=8).collect(), texts, 8)


def test_exchanges_keep_counts_and_packing_fills_rooms():
    rng = random.Random(3)
    for _ in range(200):
        wishes = {(s, t): rng.randint(1, 9) for s in range(6) for t in range(6) if s != t and rng.random() < 0.5}
        free = [rng.choice([0, 0, 5]) for _ in range(6)]
        moved, given = _exchange(wishes, free)
        for s in range(6):
            flow = [n if a == s else -n if b == s else 0 for x in (moved, given) for (a, b), n in x.items()]
            assert sum(flow) == 0 and sum(n for (a, _), n in given.items() if a == s) <= free[s]
        assert all(n <= wishes[e] for e, n in moved.items())
    assert _exchange({(0, 1): 4, (1, 2): 3, (2, 0): 3}, [0, 1, 0]) == ({(0, 1): 4, (1, 2): 3, (2, 0): 3}, {(1, 0): 1})
    groups = Counter(rng.randint(2, 40) for _ in range(400))
    total = sum(z * n for z, n in groups.items())
    room = [total // 8 + (s < total % 8) for s in range(8)]
    plan, lost = _pack(groups, room)
    assert lost == 0 and [sum(z * n for z, p in plan.items() for t, n in p if t == s) for s in range(8)] == room


def test_few_repeated_and_no_rows(spark):
    rows = shard_documents(docs(spark, ["a", "a", "b"], [1, 1, None])).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [1, 1, 1]
    assert shard_documents(docs(spark, [])).count() == 0


def test_propagation_cuts_fewer_links_each_round(spark):
    texts = [f"four {g}" for g in range(60)] * 4 + [f"pair {g}" for g in range(50)] * 2 + [f"single {i}" for i in range(30)]
    cut = []
    rows = shard_documents(docs(spark, texts), shards=8, cut=cut).collect()
    assert len(cut) >= 2 and all(a > b for a, b in zip(cut, cut[1:-1])) and cut[-1] < cut[0] / 4
    check(rows, texts, 8)


def test_null_and_repeated_ids(spark):
    texts, ids = ["a", "a", "b", "b", None, "", "c" * 100_000, "a"], [1, 1, 1, None, None, 2, 3, None]
    rows = shard_documents(docs(spark, texts, ids), shards=3).collect()
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), len(t or "") + 1) for i, t in zip(ids, texts))
    assert sorted(Counter(r.shard for r in rows).values()) == [2, 3, 3]
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in Counter(r.shard for r in rows).items())
