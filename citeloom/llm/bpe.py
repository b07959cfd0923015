"""Byte-level BPE: a minimal perfect hash for whole pieces, a heap of merges for the rest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from heapq import heapify, heappop, heappush, heapreplace
from itertools import chain, pairwise, product

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.vocabulary import read_ranks

#: Stretches, and pre-tokens that no space and letters make, in each of the two generations
#: that a worker remembers.
REMEMBERED, REMEMBERED_OTHERS = 300_000, 30_000
#: Characters encoded at a time.
PART = 1 << 20
_MASK = (1 << 64) - 1
#: Letters in every version of Unicode in use.
_LETTER = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
_LETTERS = re.compile(f"{_LETTER}+").fullmatch
#: A word of them and the punctuation behind it.
_ENDED = re.compile(f"( ?{_LETTER}+)([!-/:-@[-`{{-~]+)").fullmatch
_WHITE_BEFORE_SPACE = [chr(c) + " " for c in range(0x3001) if chr(c).isspace()]
_ASCII_BEFORE_SPACE = [w for w in _WHITE_BEFORE_SPACE if w.isascii()]


def _spread(digest: int, seed: int) -> int:
    x = (digest + seed * 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ x >> 31) * 0xBF58476D1CE4E5B9) & _MASK
    return x ^ x >> 29


class PerfectHash:
    """Every key has a slot of its own and no slot is empty.

    Keys fall into buckets by their digest. Each bucket of several keys,
    largest first, takes the first seed that sends all of them to free slots;
    a bucket of one key names its slot directly. A lookup costs one digest, one
    seed and one comparison.
    """

    def __init__(self, table: dict[bytes, int]) -> None:
        size = self.size = max(len(table), 1)
        self.seed = 0
        while len({xxhash.xxh3_64_intdigest(k, self.seed) for k in table}) < len(table):
            self.seed += 1
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(size)]
        for key in table:
            digest = xxhash.xxh3_64_intdigest(key, self.seed)
            buckets[digest % size].append((digest, key))
        self.seeds = [0] * size
        self.keys: list[bytes | None] = [None] * size
        order = sorted(range(size), key=lambda b: -len(buckets[b]))
        free = iter(())
        for b in order:
            bucket = buckets[b]
            if len(bucket) > 1:
                seed = 1
                while True:
                    slots = [_spread(digest, seed) % size for digest, _ in bucket]
                    if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                        break
                    seed += 1
                self.seeds[b] = seed
            elif bucket:
                if self.seeds[b] == 0 and not isinstance(free, chain):
                    free = chain([s for s in range(size) if self.keys[s] is None])
                slots = [next(free)]
                self.seeds[b] = -slots[0] - 1
            else:
                break
            for slot, (_, key) in zip(slots, bucket, strict=True):
                self.keys[slot] = key
        self.values = [table[k] if k is not None else -1 for k in self.keys]

    def get(self, key: bytes) -> int | None:
        digest = xxhash.xxh3_64_intdigest(key, self.seed)
        seed = self.seeds[digest % self.size]
        slot = -seed - 1 if seed < 0 else _spread(digest, seed) % self.size
        return self.values[slot] if self.keys[slot] == key else None


class Merges:
    """Merges of the pieces that are not in the vocabulary as a whole.

    A piece is a doubly linked list of ids, at first of its bytes; a heap holds
    the neighbouring pairs that may merge, lowest rank and leftmost first. An
    entry is stale when the pair at its place has another rank by now.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.first = [ranks.get(bytes(pair)) for pair in product(range(256), repeat=2)]
        self.shift = max(ranks.values()).bit_length()
        self.pairs = {
            ranks[piece[:k]] << self.shift | ranks[piece[k:]]: rank
            for piece, rank in ranks.items()
            for k in range(1, len(piece))
            if piece[:k] in ranks and piece[k:] in ranks
        }

    def ids(self, word: bytes) -> tuple[int, ...]:
        get, shift, first = self.pairs.get, self.shift, self.first
        part: list = [*map(self.single.__getitem__, word)]
        n = len(part)
        # The pairs of bytes are looked up by the bytes, all later ones by their ids.
        rank_at: list = [first[a << 8 | b] for a, b in pairwise(word)]
        rank_at.append(None)
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [rank << bits | i for i, rank in enumerate(rank_at) if rank is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heap[0]
            i, rank = entry & low, entry >> bits
            if rank_at[i] != rank:
                heappop(heap)
                continue
            j = after[i]
            k = after[i] = after[j]
            part[i], part[j], rank_at[j] = rank, None, None
            found = None
            if k < n:
                before[k] = i
                found = get(rank << shift | part[k])
            rank_at[i] = found
            # The merged entry is still on top: the new one takes its place.
            if found is None:
                heappop(heap)
            else:
                heapreplace(heap, found << bits | i)
            k = before[i]
            if k >= 0:
                found = rank_at[k] = get(part[k] << shift | rank)
                if found is not None:
                    heappush(heap, found << bits | k)
        return tuple([x for x in part if x is not None])


class Codec:
    """Encoder and decoder of one vocabulary. ``pattern`` cuts text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        self.pattern = pattern
        self.merges = Merges(ranks)
        self.whole = PerfectHash(ranks)
        self.names = {i: str(i).encode() for i in ranks.values()}
        self.pieces = {i: piece for piece, i in ranks.items()}
        self._ready()

    def _ready(self) -> None:
        self.find = regex.compile(self.pattern).findall
        self.apart = regex.compile(r"(?<=\S)(?= )", flags=regex.V1).split
        # A word of letters is a pre-token where only apostrophes may come before it in the pattern.
        others = [a for a in self.pattern.split("|") if not a.startswith("'")]
        self.letters = others[:1] == [r" ?\p{L}+"]
        # No letter follows the apostrophes of punctuation that ends a stretch.
        self.marks = others[:3] == [r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+"]
        self.ids_of = _Stretches(self, lambda ids: ids, lambda parts: tuple(chain.from_iterable(parts)))
        self.texts_of = _Stretches(self, self._texts, _joined_texts)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "apart", "ids_of", "texts_of")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def piece(self, token: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        data = token.encode()
        known = self.whole.get(data)
        return self.merges.ids(data) if known is None else (known,)

    def _texts(self, ids: tuple[int, ...]) -> tuple[bytes, bytes]:
        return b",".join(map(self.names.__getitem__, ids)), self.decode(ids)

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of the whole text, some 10^5 to 10^6 at a time."""
        for part in self._parts(text):
            yield list(chain.from_iterable(self.ids_of.each(part)))

    def written(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """The ids in decimal, joined by commas, and the bytes they decode to, part by part."""
        for part in self._parts(text):
            if part:
                yield _joined_texts(self.texts_of.each(part))

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART:
            cut = at + PART
            while True:
                cut = text.find(" ", cut)
                if cut < 0 or not text[cut - 1].isspace():
                    break
                cut += 1
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def _joined_texts(parts: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    return b",".join([p[0] for p in parts]), b"".join([p[1] for p in parts])


class _Stretches:
    """Remembers stretches of text, with what is made of their ids.

    No pre-token of a pattern in which white space is followed only by white
    space crosses a space after a character that is no white space, so a text
    is cut there and the stretches between are encoded once each. They are
    remembered by what follows the space.
    """

    def __init__(self, codec: Codec, made: Callable, joined: Callable) -> None:
        self.codec, self.joined = codec, joined
        self.spaced = _Memory(lambda rest: self.of(" " + rest), REMEMBERED)
        self.others = _Memory(lambda token: made(codec.piece(token)), REMEMBERED_OTHERS)
        self.made = made

    def of(self, text: str):
        """What is made of a stretch, from its pre-tokens."""
        if self.codec.letters and _LETTERS(text, text[:1] == " "):
            return self.made(self.codec.piece(text))
        ended = _ENDED(text) if self.codec.marks else None
        if ended:
            word, marks = ended.groups()
            return self.joined([self._token(word), self.others[marks]])
        tokens = self.codec.find(text)
        if len(tokens) == 1:
            return self.made(self.codec.piece(text)) if tokens[0] == text else self.others[tokens[0]]
        return self.joined([self._token(t) for t in tokens])

    def _token(self, token: str):
        if self.codec.letters and token[0] == " " and _LETTERS(token, 1):
            return self.spaced[token[1:]]
        return self.others[token]

    def each(self, part: str) -> list:
        spaced = self.spaced.__getitem__
        whites = _ASCII_BEFORE_SPACE if part.isascii() else _WHITE_BEFORE_SPACE
        if part[:1] == " " or any(white in part for white in whites):
            return [spaced(s[1:]) if s[:1] == " " else self.of(s) for s in self.codec.apart(part)]
        first, *rest = part.split(" ")  # every space begins a stretch
        return [self.of(first), *map(spaced, rest)]


class _Memory(dict):
    """Found before; what was not asked for among the last ``most`` new ones is forgotten."""

    def __init__(self, find: Callable, most: int) -> None:
        self.find, self.most = find, most
        self.former: dict = {}

    def __missing__(self, key):
        found = self.former.get(key)
        if found is None:
            found = self.find(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.former = dict(self)
                self.clear()
            self[key] = found
        return found


def load_codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def encode_column(texts: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids`` (array<int>) of every whole text; a null text has no ids."""
    shared = texts.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids = list(chain.from_iterable(own.encode(batch.column(1)[row].as_py() or "")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([ids], pa.list_(pa.int32()))], ["id", "ids"]
                )

    kind = texts.schema[id_col].dataType.simpleString()
    return (
        texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {kind}, ids array<int>")
        .withColumnRenamed("id", id_col)
    )


def round_trip(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and return the digests of both.

    Result: id, ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas),
    ``decoded_sha256`` (decoded bytes). Ids are hashed part by part, so a long
    text needs no memory beyond a part. A null text counts as empty; repeated
    rows and null ids give rows of their own; an empty table gives no rows;
    other columns are ignored. Only the vocabulary is shipped to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            counts, listed, decoded = [], [], []
            for cell in batch.column(1):
                n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                for ids, data in own.written(cell.as_py() or ""):
                    of_ids.update(b"," + ids if n else ids)
                    of_bytes.update(data)
                    n += ids.count(b",") + 1
                counts.append(n)
                listed.append(of_ids.hexdigest())
                decoded.append(of_bytes.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(listed), pa.array(decoded)],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("id", id_col)
    )
