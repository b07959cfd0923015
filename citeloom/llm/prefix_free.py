"""Suffix order of many short texts by prefix-free parsing."""

from __future__ import annotations

import numpy as np

#: Bytes of a trigger, and one in how many of its values is one.
TRIGGER, RARITY = 6, 8


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks from 1; equal keys share one."""
    return np.unique(keys, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of the suffix at each place among all; a suffix stops at ``ends`` of its own text.

    Prefix doubling: ranks by the first s symbols give ranks by the first 2 s.
    Equal suffixes share a rank, a suffix that stops sorts first.
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    here = np.arange(n)
    left = ends - here
    ranks = _dense(symbols.astype(np.int64))
    size, longest = 1, int(left.max())
    while size < longest:
        after = np.zeros(n, np.int64)
        more = left > size
        after[more] = ranks[here[more] + size]
        ranks = _dense(ranks * (n + 2) + after)
        size *= 2
        if ranks.max() == n:
            break
    return ranks


def _trigger(text: np.ndarray) -> np.ndarray:
    """True where a trigger begins: a rolling hash of the next bytes is divisible by the rarity."""
    value = np.zeros(len(text), np.uint64)
    for k in range(min(TRIGGER, len(text))):
        part = np.zeros(len(text), np.uint64)
        part[: len(text) - k] = text[k:]
        value = value * np.uint64(0x100000001B3) + part + np.uint64(1)
    value ^= value >> np.uint64(33)
    value *= np.uint64(0xFF51AFD7ED558CCD)
    return (value >> np.uint64(40)) % np.uint64(RARITY) == 0


def corpus_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of the concatenated texts in lexicographic order of their suffixes.

    ``ends`` holds for each place where its own text ends. Triggers cut each
    text into phrases that overlap by a trigger. The dictionary holds distinct
    phrases, the parse their numbers in text order. A suffix begins inside one
    phrase: its rank among the dictionary's suffixes decides, and among equal
    ones the rank of the parse from the next phrase on, since no proper suffix
    of a phrase that is longer than a trigger begins another one.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    here = np.arange(n)
    begins = np.zeros(n, bool)
    begins[0] = True
    begins[ends[:-1][np.diff(ends) != 0]] = True
    starts = np.flatnonzero(begins | (_trigger(text) & (here + TRIGGER < ends)))
    follows = np.append(starts[1:], n)
    last = follows >= ends[starts]
    stops = np.where(last, ends[starts], np.minimum(follows + TRIGGER, ends[starts]))
    raw = text.tobytes()
    numbers: dict[bytes, int] = {}
    parse = np.fromiter(
        (numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)),
        np.int64,
        len(starts),
    )
    lengths = np.array([len(p) for p in numbers], np.int64)
    heads = np.cumsum(lengths) - lengths
    dictionary = np.frombuffer(b"".join(numbers), np.uint8)
    of_dictionary = suffix_ranks(dictionary, np.repeat(heads + lengths, lengths))
    lexical = of_dictionary[heads]
    # The parse of a text ends with the text.
    closing = np.flatnonzero(last)
    parse_end = closing[np.searchsorted(closing, np.arange(len(starts)))] + 1
    of_parse = np.append(suffix_ranks(lexical[parse], parse_end), 0)
    phrase = np.searchsorted(starts, here, side="right") - 1
    inside = of_dictionary[heads[parse[phrase]] + here - starts[phrase]]
    after = np.where(last[phrase], 0, of_parse[np.minimum(phrase + 1, len(starts))])
    return np.argsort(inside * (len(starts) + 2) + after, kind="stable")


def equal_windows(text: np.ndarray, ends: np.ndarray, wanted: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Wanted places with ``size`` bytes left, in suffix order, and where a new string begins."""
    order = corpus_order(text, ends)
    order = order[wanted[order] & (ends[order] - order >= size)]
    fresh = np.ones(len(order), bool)
    reach = np.arange(size)
    for at in range(1, len(order), 1 << 16):
        to = min(len(order), at + (1 << 16))
        windows = text[order[at - 1 : to, None] + reach]
        fresh[at:to] = (windows[1:] != windows[:-1]).any(axis=1)
    return order, fresh
