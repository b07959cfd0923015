"""Vocabulary files as bounded tables, and cuts that keep long texts in bounded memory."""

from __future__ import annotations

import base64
from collections.abc import Iterator


def read_ranks(path: str) -> dict[bytes, int]:
    """Pieces and ranks of a rank file: base64 piece, space, rank."""
    with open(path, "rb") as lines:
        return {
            base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines) if piece
        }


def word_segments(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """Consecutive parts of about ``size`` bytes, cut only at a space."""
    at = 0
    while len(data) - at > size:
        cut = data.rfind(b" ", at, at + size)
        if cut <= at:
            cut = data.find(b" ", at + size)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut
    yield data[at:] if at else data
