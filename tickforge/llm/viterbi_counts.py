"""Token counts of a unigram tokenizer by count-only Viterbi.

A vocabulary of pieces with log scores is searched by an Aho-Corasick automaton that lists
the pieces ending at each character; dynamic programming carries, for each end, the best
score, the number of pieces on its path, and whether the last of them is unknown.  No path
is kept.  The rules are those of the Unigram model of the tokenizers library: a character
that no piece of its own covers is unknown at the least score minus 10; the first start that
reaches the best score wins ties; neighbouring unknown pieces count as one.

A text is cut before each space (spaces become the mark of a word's start, and one is put
before the text), and words are scored on their own, so each different word of a task's
texts is scored once while it is held.

No vocabulary of this kind comes with the public tokenizers, and none is trained here: the
pieces and scores of the sentencepiece file are used as a unigram vocabulary, and counts are
tested against the tokenizers library with the same vocabulary.  Any other can be given.

Scale: one pass over the texts, no shuffle.  Beside a word itself, memory is bounded by the
longest piece, so a very long text without spaces is one word like others.  Null and empty
texts have no tokens.  Repeated rows count alike; an empty table gives no rows; further
columns are not looked at.  Words are found by hash, and their bytes compared.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .kernel import Grown, HeldSpans, byte_view, distinct_spans, slices
from .shared import table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MOST_WORDS, MOST_BYTES = 2_000_000, 64 << 20  # words that a worker holds, and their bytes


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece file, by id; control, byte and unknown pieces keep their places."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(held.id_to_piece(i), float(held.get_score(i))) for i in range(held.get_piece_size())]


class Viterbi:
    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        seen = {}
        for i, (piece, score) in enumerate(pieces):
            seen[piece] = (len(piece), score, i == unknown)
        for piece, value in seen.items():
            self.automaton.add_word(piece, value)
        self.automaton.make_automaton()
        self.unknown_score = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.single = {piece for piece in seen if len(piece) == 1}
        self.ring = 1 + max((len(piece) for piece in seen), default=1)

    def count(self, word: str) -> int:
        """How many pieces the best path over the word has.  What is carried are the ends that the longest piece reaches back to."""
        ring = self.ring
        score, count, unknown = [0.0] * ring, [0] * ring, [False] * ring
        matches = self.automaton.iter(word)
        last, value = next(matches, (-1, None))
        for end in range(1, len(word) + 1):
            best, of, is_unknown = 0.0, -1, False
            while last == end - 1:  # longest first, so starts ascend
                size, own, blank = value
                start = (end - size) % ring
                if of < 0 or own + score[start] > best:
                    best, of, is_unknown = own + score[start], start, blank
                last, value = next(matches, (-1, None))
            before, here = (end - 1) % ring, end % ring
            if word[end - 1] not in self.single and (of < 0 or self.unknown_score + score[before] > best):
                best, of, is_unknown = self.unknown_score + score[before], before, True
            count[here] = count[of] + (not (is_unknown and unknown[of]))
            score[here], unknown[here] = best, is_unknown
        return count[len(word) % ring]


class Words:
    """Counts of words, each word scored once as long as it is held.  Found by hash; a held word counts only if its bytes are the same."""

    def __init__(self, viterbi: Viterbi):
        self.viterbi, self.held, self.counts = viterbi, HeldSpans(), Grown(np.int64)

    def totals(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each document of data[offsets[0]:offsets[-1]]."""
        lo, hi = int(offsets[0]), int(offsets[-1])
        raw, local = data[lo:hi], offsets - lo
        n = len(raw)
        if not n:
            return np.zeros(len(offsets) - 1, np.int64)
        cut = np.append(raw == 0x20, True)
        cut[local] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n)
        spaced = raw[starts] == 0x20
        marked = np.zeros(n, bool)  # a text that starts with the mark gets none before it
        heads = local[:-1][np.diff(local) >= 3]
        marked[heads] = (raw[heads] == 0xE2) & (raw[heads + 1] == 0x96) & (raw[heads + 2] == 0x81)
        bare = marked[starts]
        known, first, at = distinct_spans(raw, starts, ends)
        size = (ends - starts)[first]
        if len(self.held) > MOST_WORDS or self.held.bytes.n > MOST_BYTES:
            self.held, self.counts = HeldSpans(), Grown(np.int64)
        place = self.held.find(known, raw, starts[first], size)
        counts, new = self.counts.data[np.maximum(place, 0)], np.flatnonzero(place < 0)
        if len(new):
            buf, made = raw.tobytes(), []
            for i in first[new].tolist():
                word = buf[starts[i] : ends[i]].decode()
                made.append(self.viterbi.count(word if bare[i] else MARK + word[1:] if spaced[i] else MARK + word))
            counts[new] = made
            keep = new[place[new] == -1]
            self.held.add(known[keep], raw, starts[first[keep]], size[keep])
            self.counts.append(counts[keep])
        before = np.append(0, np.cumsum(counts[at]))
        return np.diff(before[np.searchsorted(starts, local)])


@lru_cache(maxsize=1)
def _words(vocabulary: str) -> Words:
    """The worker's own, kept from task to task."""
    return Words(Viterbi(unigram_pieces(vocabulary)))


def token_counts(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars: code points, n_tokens) of every row of docs; vocabulary: path of a sentencepiece file that tasks can read."""
    vocabulary = vocabulary or default_vocabulary()

    def run(batches):
        words = _words(vocabulary)
        for batch in batches:
            data, offsets = byte_view(batch.column(2))
            n = [words.totals(data, offsets[lo : hi + 1]) for lo, hi in slices(offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, np.int64), *n]))], ["doc_id", "n_chars", "n_tokens"])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_chars"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, n_chars long, n_tokens long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
