"""The piece table of a SentencePiece model file, and the cutting of text into words that pieces never cross.

A text is encoded as the model does without normalisation: a space in front, spaces as the mark, and
characters of no piece as their UTF-8 bytes. A path's score is the sum of its pieces' scores; the
best path wins, of equal ones that of fewer ids.
"""

from __future__ import annotations

import re
from functools import lru_cache
from operator import add

SPACE = "▁"
#: How much worse a character of no piece is than the worst piece, as in the library.
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    def __init__(self, model: str):
        from sentencepiece import SentencePieceProcessor

        source = SentencePieceProcessor(model_file=model)
        ids = range(source.get_piece_size())
        special = (source.is_control, source.is_unknown, source.is_byte, source.is_unused)
        self.pieces = {source.id_to_piece(i): (i, source.get_score(i)) for i in ids if not any(f(i) for f in special)}
        self.bytes = [source.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown_score = min(score for _, score in self.pieces.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces))
        self.surface = {i: piece.replace(SPACE, " ").encode() for piece, (i, _) in self.pieces.items()}
        self.surface |= {i: bytes([b]) for b, i in enumerate(self.bytes)}
        #: Neighbouring characters that some piece holds; every path is cut between others.
        self.joined = {a + b for piece in self.pieces for a, b in zip(piece, piece[1:])}
        if any(b == SPACE != a for a, b in self.joined):
            raise ValueError("pieces that go on after a space are not supported")
        lone = "" if any("\n" in pair for pair in self.joined) else "\n"
        self.pattern = re.compile(f"{SPACE}+[^{SPACE}{lone}]*|[^{SPACE}{lone}]+" + "|\n" * bool(lone))

    def words(self, text: str) -> list[str]:
        """Words in order, each with its spaces in front."""
        return self.pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def parts(self, word: str) -> list[str]:
        """The word cut wherever no piece holds both neighbours. Parts are encoded each on its own."""
        joined = self.joined
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def byte_ids(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: exact for ids that came from one, without the space in front."""
        return b"".join([self.surface[i] for i in ids]).decode(errors="replace")[1:]


@lru_cache(maxsize=2)
def load_pieces(model: str) -> Pieces:
    return Pieces(model)
