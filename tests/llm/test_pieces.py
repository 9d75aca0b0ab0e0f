import hashlib
import random

from quillstone.llm import pieces
from quillstone.llm.pieces import SPACE, Codec, Vocabulary, decode_documents, encode_documents
from tests.llm.cases import CLASH, docs


def brute(codec, text):
    """Plain dynamic programming over all substrings; of equal sums, the longest last piece."""
    pieces = {p: (s, i) for p, i, s in codec.vocabulary.pieces}
    best = [(0.0, None)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 40), end):
            if text[start:end] in pieces:
                s, i = pieces[text[start:end]]
                if best[end] is None or best[start][0] + s > best[end][0]:
                    best[end] = (best[start][0] + s, (start, [i]))
        if best[end] is None or best[end - 1][0] + codec.unknown > best[end][0]:
            best[end] = (best[end - 1][0] + codec.unknown, (end - 1, [codec.vocabulary.byte_ids[b] for b in text[end - 1].encode()]))
    out, at = [], len(text)
    while at:
        start, ids = best[at][1]
        out, at = ids + out, start
    return out


TEXTS = [None, "", " ", "\n", "Hello world", "  two  spaces ", "é€😀 ünï", f"a{SPACE}b{SPACE}{SPACE}", "x" * 3000, "日本語の text\twith tabs", "<s> </s> <0x41>"]


def test_viterbi_equals_brute_force():
    codec = Codec(Vocabulary())
    assert codec.vocabulary.by_word
    rng = random.Random(3)
    texts = [t for t in TEXTS if t] + ["".join(rng.choices("abcde thiong.é\n日́", k=rng.randint(1, 60))) for _ in range(200)]
    for t in texts:
        if SPACE not in t and len(t) < 200:
            assert list(codec.encode(t)) == brute(codec, (" " + t).replace(" ", SPACE)), t
        assert codec.decode(codec.encode(t)) == t


def test_documents_round_trip(spark):
    frame = docs(spark, TEXTS + ["dup", "dup"], [*range(len(TEXTS)), None, None], CLASH)
    encoded = encode_documents(frame)
    rows = encoded.collect()
    assert len(rows) == len(TEXTS) + 2 and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    back = {r.doc_id: r.text for r in decode_documents(encoded).collect() if r.doc_id is not None}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert encode_documents(docs(spark, [])).count() == 0


def test_vocabularies_that_differ_in_one_piece_have_codecs_of_their_own():
    one, two = Vocabulary(), Vocabulary()
    used = pieces._codec(one).encode("the")[0]
    at = next(k for k, (_, i, _) in enumerate(two.pieces) if i == used)
    two.pieces[at] = (two.pieces[at][0], two.pieces[at][1], -1e6)
    two.key = hashlib.sha256(repr((two.pieces, two.byte_ids)).encode()).hexdigest()
    assert pieces._codec(one).encode("the") != pieces._codec(two).encode("the")
