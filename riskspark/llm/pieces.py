"""The piece vocabulary that the token operators share.

A SentencePiece model file gives the pieces; each normal piece gets a unigram score from its
rank in the file (Zipf's law). Scores are multiples of 1/16, so sums of them are exact in 32 and
64 bits alike and ties are real ties.

Spaces are written as a mark before the text is cut, and one mark is put in front. No piece has a
mark after another character, so the cuts before each run of marks are cuts in every
segmentation: a text is a row of independent words.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Fixed value: how far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    ids: tuple[int, ...]
    # Id of each byte's piece, or nothing where unknown characters become one unknown piece.
    byte_ids: tuple[int, ...]
    unknown_id: int
    unknown_score: float

    def unknown(self, char: str) -> list[int]:
        """Ids that stand for a character without a piece."""
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown_id]


def zipf_score(rank: int, n: int) -> float:
    return -round(16 * math.log(rank * (math.log(n) + 0.5772))) / 16


def vocabulary(pieces: list[tuple[str, int]], byte_ids: tuple[int, ...] = (), unknown_id: int = 0) -> Vocabulary:
    """From (piece, id) pairs by falling frequency."""
    if any(MARK in p.lstrip(MARK) for p, _ in pieces):
        raise ValueError("a piece goes on after a space, so texts cannot be cut into words")
    scores = tuple(zipf_score(r + 1, len(pieces)) for r in range(len(pieces)))
    return Vocabulary(
        tuple(p for p, _ in pieces),
        scores,
        tuple(i for _, i in pieces),
        byte_ids,
        unknown_id,
        min(scores, default=0.0) - UNKNOWN_PENALTY,
    )


def load(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file on the driver; tasks get the vocabulary, not the path."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    normal, byte_ids = [], {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((model.id_to_piece(i), i))
    return vocabulary(
        normal, tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (), model.unk_id()
    )


def marked_words(text: str) -> list[str]:
    """Independent words of a text, marks included; an empty text has none."""
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return _WORD.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]
