"""Token counts: the number of pieces in the best unigram segmentation, without the pieces."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import text_slices
from riskspark.llm.pieces import Vocabulary, marked_words

# Words whose counts a task remembers, and the longest word that it remembers.
REMEMBERED, LONGEST = 300_000, 48


class Counter:
    """Best score and piece count of words, by one pass over an Aho-Corasick automaton's matches.

    Ties follow the tokenizer: of equal segmentations up to a place, the one whose last piece
    begins first is kept. An unknown character is one step of the segmentation and counts as
    its UTF-8 bytes where the vocabulary has byte pieces; without them a run of unknown
    characters is one piece.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores, strict=True):
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.known: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        unknown, byte_ids = self.vocabulary.unknown_score, self.vocabulary.byte_ids
        n = len(word)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if self.vocabulary.pieces:
            for end, match in self.automaton.iter(word):
                matches[end + 1].append(match)
        best, count, lost = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, single = None, 0, False
            for length, score in matches[end]:  # the longest first
                single |= length == 1
                value = best[end - length] + score
                if top is None or value > top:
                    top, pieces = value, count[end - length] + 1
            if not single:
                value = best[end - 1] + unknown
                if top is None or value > top:
                    top, lost[end] = value, True
                    cost = len(word[end - 1].encode()) if byte_ids else int(not lost[end - 1])
                    pieces = count[end - 1] + cost
            best[end], count[end] = top, pieces
        return best[n], count[n]

    def text(self, text: str) -> tuple[float, int]:
        known, score, count = self.known, 0.0, 0
        if not self.vocabulary.byte_ids:
            # Unknown characters merge over word ends too, so the text is one word.
            return self.word("".join(marked_words(text)))
        for word in marked_words(text):
            found = known.get(word)
            if found is None:
                found = self.word(word)
                if len(word) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = found
            score += found[0]
            count += found[1]
        return score, count


def token_counts(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, score) of every row: pieces and score of its whole text's best segmentation.

    Null and empty texts have no tokens and score 0. Null and repeated keys stay as they are,
    an empty table gives an empty result, other columns are ignored. Row by row, no shuffle;
    the vocabulary that goes to the tasks has a fixed size.
    """
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for rows, _, _ in text_slices(batches):
            found = [counter.text(t or "") for t in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([c for _, c in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())],
                names=["id", "n_tokens", "score"],
            )

    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(apply, f"id {kind}, n_tokens long, score double").withColumnRenamed("id", key)
