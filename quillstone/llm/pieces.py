"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a Viterbi pass."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import set_batches

#: A public vocabulary; where it lies is a parameter of every operator.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: What a character outside the vocabulary costs below the worst piece, as in the public unigram model.
UNKNOWN_PENALTY = 10.0
#: Encoded words that a Python worker remembers at most.
REMEMBERED = 200_000


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; small and fixed, so it is sent to the workers as it is."""

    def __init__(self, model: str = MODEL):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.pieces: list[tuple[str, int, float]] = []
        self.raw: list[bytes] = []
        self.byte_ids = [-1] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.raw.append(b"")
            else:
                self.pieces.append((piece, i, sp.get_score(i)))
                self.raw.append(piece.replace(SPACE, " ").encode())
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces, so texts can't be restored")
        #: Names the vocabulary: all its pieces, ids and scores.
        self.key = hashlib.sha256(repr((self.pieces, self.byte_ids)).encode()).hexdigest()
        #: No piece has a space mark after another character: then no path crosses the start of a word.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces)


class Codec:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, _, s in vocabulary.pieces) - UNKNOWN_PENALTY
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if vocabulary.by_word else r"(?s).+")
        self.mark = [vocabulary.byte_ids[b] for b in SPACE.encode()]
        self.known: dict[str, tuple[int, ...]] = {}

    def viterbi(self, text: str) -> tuple[int, ...]:
        """The ids with the highest sum of scores; of equal sums, the one whose last piece is longest.

        The automaton reads each character once; at each end position its output links give the
        pieces that end there, longest first, and each relaxes the best score of the position.
        """
        n = len(text)
        best, last, size = [0.0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        done = 0  # positions whose best score is final
        minus = float("-inf")
        for i in range(1, n + 1):
            best[i] = minus
        for end, (length, i, score) in self.automaton.iter(text):
            while done < end:  # positions that no piece reaches take their character as bytes
                done += 1
                self._settle(best, last, size, done)
            value = best[end + 1 - length] + score
            if value > best[end + 1]:
                best[end + 1], last[end + 1], size[end + 1] = value, i, length
        while done < n:
            done += 1
            self._settle(best, last, size, done)
        out: list[int] = []
        at = n
        while at:
            if last[at] >= 0:
                out.append(last[at])
            else:
                out.extend(self.vocabulary.byte_ids[b] for b in reversed(text[at - 1].encode()))
            at -= size[at]
        return tuple(reversed(out))

    def _settle(self, best: list[float], last: list[int], size: list[int], at: int) -> None:
        value = best[at - 1] + self.unknown
        if value > best[at]:
            best[at], last[at], size[at] = value, -1, 1

    def encode(self, text: str) -> array:
        """A space is put first, as in the public format; a space mark in the text itself goes as bytes."""
        ids = array("i")
        if not text:
            return ids
        known = self.known
        for k, part in enumerate(text.split(SPACE)):
            if k:
                ids.extend(self.mark)
            for word in self.words.findall(((" " if not k else "") + part).replace(" ", SPACE)):
                found = known.get(word)
                if found is None:
                    found = self.viterbi(word)
                    if len(word) <= 64:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = found
                ids.extend(found)
        return ids

    def decode(self, ids) -> str:
        raw = self.vocabulary.raw
        return b"".join([raw[i] for i in ids])[1:].decode()


_codecs: dict[str, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """The worker's codec of a vocabulary; it keeps one."""
    if vocabulary.key not in _codecs:
        _codecs.clear()
        _codecs[vocabulary.key] = Codec(vocabulary)
    return _codecs[vocabulary.key]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_tokens, ids, round_trip.

    round_trip says whether the decoded ids equal the text. Of encodings with equal sums of scores, the one
    whose last piece is longest is taken, and so on backwards. Null text is empty and has no ids. Long
    texts are encoded whole, word by word where the vocabulary allows it; memory follows the longest word
    and the batch. Repeated rows each get their row, null ids stay null. Other columns are ignored.
    """
    spark = docs.sparkSession
    set_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                ends, flat, same = [0], array("i"), []
                for text in part.column(1).to_pylist():
                    ids = codec.encode(text or "")
                    flat.extend(ids)
                    ends.append(len(flat))
                    same.append(codec.decode(ids) == (text or ""))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends)), lists, pa.array(same)], names=["doc_id", "n_tokens", "ids", "round_trip"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids are the empty text."""
    spark = encoded.sparkSession
    set_batches(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            texts = [codec.decode(ids.as_py() or ()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
