"""Passages of test items in documents, found with a generalised suffix automaton over words."""

from __future__ import annotations

import math
import pickle
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.vocabulary import word_segments
from citeloom.sources.staged import new_stage_path, write_stage

#: Consecutive item words that make a window.
WINDOW = 10
#: Words of test items that one automaton holds, about; more items make more automata.
AUTOMATON_WORDS = 1_000_000
#: Words of one piece of a long item; pieces overlap by a window less one word.
PIECE_WORDS = 100_000
#: Every byte that is no part of a word becomes a space; ASCII capitals become small.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
    for b in range(256)
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """All substrings of word sequences, with the items behind windows and behind short items.

    State 0 is the empty match. Most states have one way on, kept in two
    arrays; further ways are in a dictionary.
    """

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.length, self.link = array("q", [0]), array("q", [-1])
        self.first_word, self.first_to = array("q", [-1]), array("q", [-1])
        self.more: dict[tuple[int, int], int] = {}
        self.items: list[str] = []
        self.held: dict[int, list[int]] = {}  # state of a window, or of a whole short item
        self.shortest = window
        self._texts: list[tuple[int, list[int]]] = []

    def _state(self, length: int, like: int | None = None) -> int:
        self.length.append(length)
        self.link.append(-1 if like is None else self.link[like])
        self.first_word.append(-1 if like is None else self.first_word[like])
        self.first_to.append(-1 if like is None else self.first_to[like])
        return len(self.length) - 1

    def step(self, state: int, word: int) -> int:
        if self.first_word[state] == word:
            return self.first_to[state]
        return self.more.get((state, word), -1)

    def _set(self, state: int, word: int, to: int) -> None:
        if self.first_word[state] in (-1, word):
            self.first_word[state], self.first_to[state] = word, to
        else:
            self.more[state, word] = to

    def _split(self, state: int, word: int, to: int, ways: dict[int, list[int]]) -> int:
        """The part of ``to`` that is one word longer than ``state`` becomes a state of its own."""
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1, to)
        ways[copy] = list(ways.get(to, ()))
        for w in ways[copy]:
            if (to, w) in self.more:
                self.more[copy, w] = self.more[to, w]
        self.link[to] = copy
        while state >= 0 and self.step(state, word) == to:
            self._set(state, word, copy)
            state = self.link[state]
        return copy

    def add(self, texts: list[tuple[str, list[bytes]]]) -> None:
        """Take in ``(item, words)``; a text of fewer words than a window is one window."""
        known = {name: k for k, name in enumerate(self.items)}
        ways: dict[int, list[int]] = {}  # words by which a state goes on

        def extend(last: int, word: int) -> int:
            old = self.step(last, word)
            if old >= 0:
                return self._split(last, word, old, ways)
            new = self._state(self.length[last] + 1)
            while last >= 0 and self.step(last, word) < 0:
                self._set(last, word, new)
                ways.setdefault(last, []).append(word)
                last = self.link[last]
            self.link[new] = 0 if last < 0 else self._split(last, word, self.step(last, word), ways)
            return new

        for name, words in texts:
            if not words:
                continue
            if name not in known:
                known[name] = len(self.items)
                self.items.append(name)
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words]
            self._texts.append((known[name], ids))
            self.shortest = min(self.shortest, len(ids))
            last = 0
            for word in ids:
                last = extend(last, word)

    def finish(self) -> SuffixAutomaton:
        """Note which state holds which windows and which short items, and whose they are."""
        n = len(self.length)
        order = np.argsort(np.frombuffer(self.length, np.int64), kind="stable")
        self.whole_window = array("q", bytes(8 * n))  # the suffix of a window's length
        self.short_at = array("q", bytes(8 * n))  # nearest state, itself included, of a short item
        length, link = self.length, self.link
        for state in map(int, order):
            if length[state] >= self.window:
                back = link[state]
                self.whole_window[state] = state if length[back] < self.window else self.whole_window[back]
        held: dict[int, set[int]] = {}
        short: set[int] = set()
        for item, ids in self._texts:
            if len(ids) < self.window:
                state = 0
                for word in ids:
                    state = self.step(state, word)
                held.setdefault(state, set()).add(item)
                short.add(state)
                continue
            for _, state, matched in self._walk(ids, 0, len(ids)):
                if matched >= self.window:
                    held.setdefault(self.whole_window[state], set()).add(item)
        for state in map(int, order[1:]):
            self.short_at[state] = state if state in short else self.short_at[link[state]]
        self.held = {state: sorted(items) for state, items in held.items()}
        self._texts = []
        return self

    def _walk(self, ids, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(position, state, length) of the longest match that ends at each word."""
        first_word, first_to, more = self.first_word, self.first_to, self.more
        length, link = self.length, self.link
        state = matched = 0
        for at in range(begin, end):
            word = ids[at]
            while True:
                to = first_to[state] if first_word[state] == word else more.get((state, word), -1)
                if to >= 0:
                    state, matched = to, matched + 1
                    break
                state = link[state]
                if state < 0:
                    state = matched = 0
                    break
                matched = length[state]
            yield at, state, matched

    def matches(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int], int]:
        """Spans of words inside window occurrences, the items of those, and the longest match.

        ``ids`` holds -1 for a word that no item has; a match never runs over
        one, so only runs of known words as long as the shortest window are read.
        """
        known = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0])).astype(np.int8)))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        longest = 0
        length, link, window = self.length, self.link, self.window
        for begin, end in known.reshape(-1, 2).tolist():
            if end - begin < self.shortest:
                continue
            words = ids[begin:end].tolist()
            for at, state, matched in self._walk(words, 0, end - begin):
                reach = 0
                if matched >= window:
                    reach = matched
                    items.update(self.held[self.whole_window[state]])
                near = self.short_at[state if matched == length[state] else link[state]] if state else 0
                while near:
                    reach = max(reach, length[near])
                    items.update(self.held[near])
                    near = self.short_at[link[near]]
                if not reach:
                    continue
                longest = max(longest, reach)
                left, right = begin + at + 1 - reach, begin + at + 1
                while spans and spans[-1][1] >= left:
                    left = min(left, spans.pop()[0])
                spans.append((left, right))
        return spans, items, longest


def _pieces(window: int, size: int):
    """Items as pieces of bounded length that together hold the same windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(cell.as_py() or b"")
                cuts = range(0, max(len(words) - window + 1, 1), size - window + 1)
                texts = [words[c : c + size] for c in cuts] if words else []
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(texts), pa.string()),
                        pa.array([b" ".join(t) for t in texts], pa.binary()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["item", "words", "n"],
                )

    return run


def _build(window: int):
    def build(group: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton(window)
        automaton.add([(i, w.split()) for i, w in zip(group["item"].to_pylist(), group["words"].to_pylist())])
        built = pickle.dumps(automaton.finish())
        return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int64()), "built": pa.array([built], pa.binary())})

    return build


def build_automata(
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "item_id",
    text_col: str = "text",
    automaton_words: int = AUTOMATON_WORDS,
    piece_words: int = PIECE_WORDS,
) -> tuple[DataFrame, int]:
    """A staged table ``part, built`` of automata, each over about ``automaton_words`` words, and their number."""
    spark = items.sparkSession
    pieces = write_stage(
        items.select(
            F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("binary")
        ).mapInArrow(_pieces(window, max(piece_words, 2 * window)), "item string, words binary, n long"),
        new_stage_path(spark, "test-items"),
    )
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = math.ceil(total / automaton_words)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("item", "words"), F.lit(max(parts, 1))).cast("long"))
    built = dealt.groupBy("part").applyInArrow(_build(window), "part long, built binary")
    return write_stage(built, new_stage_path(spark, "automata")), parts


def _id_array(numbers: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))


def _match(shared, names: list[str], only_hits: bool):
    """``n_words, spans, items, longest`` in place of the text, the first column, beside the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: SuffixAutomaton = pickle.loads(shared.value)
        span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            n_words, spans, items, longest = [], [], [], []
            for cell in batch.column(0):
                data = (cell.as_py() or b"").translate(_WORD_BYTES)
                ids = [_id_array(automaton.numbers, part.split()) for part in word_segments(data)]
                found, whose, most = automaton.matches(np.concatenate(ids))
                n_words.append(sum(map(len, ids)))
                spans.append([{"first": a, "end": b} for a, b in found])
                items.append(sorted(automaton.items[k] for k in whose))
                longest.append(most)
            out = pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(span)),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(longest, pa.int64()),
                ],
                names=[*names, "n_words", "spans", "items", "longest"],
            )
            yield out.filter(pa.array([bool(s) for s in spans], pa.bool_())) if only_hits else out

    return run


_FOUND = "n_words long, spans array<struct<first:long,end:long>>, items array<string>, longest long"


def _joined_spans(lists: Column) -> Column:
    """Spans of several automata as maximal spans, in order."""
    span = "struct<first:bigint,end:bigint>"
    grow = lambda done, x: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["first"]),
        F.concat(
            F.slice(done, 1, F.size(done) - 1),
            F.array(
                F.struct(
                    F.element_at(done, -1)["first"].alias("first"),
                    F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                )
            ),
        ),
    ).otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(F.flatten(lists)), F.array().cast(f"array<{span}>"), grow)


def find_overlaps(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    automaton_words: int = AUTOMATON_WORDS,
    piece_words: int = PIECE_WORDS,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """The given columns, or all, plus the overlap of every whole text with the test items.

    Texts and items are lower-cased (ASCII) and cut into words of ASCII letters,
    digits and code points from 128 on. ``window`` consecutive words of an item
    are a window; an item of fewer words, but not none, is one. ``spans`` are
    the maximal runs ``[first, end)`` of words inside occurrences of windows,
    ``items`` the ids, as strings, of the items with occurring windows, in
    order; ``longest`` is the longest match in words, ``n_words`` counts words.

    Texts stay where they are read. An automaton over about ``automaton_words``
    words is broadcast; more items make several automata, long items are cut
    into overlapping pieces. With several, the texts are staged once with a row
    number and read once per automaton, and only rows with spans are shuffled.

    Null and empty texts have no words; null item ids count as the empty
    string; items that share an id are one item in ``items``; repeated rows are
    documents of their own; an empty table on either side gives no rows or no
    spans. Columns named like the added ones are overwritten.
    """
    spark = docs.sparkSession
    added = ("n_words", "spans", "items", "longest")
    kept = [c for c in (docs.columns if columns is None else columns) if c not in added]
    names = [f"c{k}" for k in range(len(kept))]
    kinds = [f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, kept)]
    data = F.col(f"`{text_col}`").cast("binary").alias("data")
    rows = docs.select(data, *(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)))
    table, parts = build_automata(items, window, item_id_col, item_text_col, automaton_words, piece_words)

    def automaton(part: int):
        row = table.where(F.col("part") == part).select("built").first()
        built = row["built"] if row else pickle.dumps(SuffixAutomaton(window).finish())
        return spark.sparkContext.broadcast(bytes(built))

    if parts <= 1:
        return rows.mapInArrow(_match(automaton(0), names, False), ", ".join([*kinds, _FOUND])).toDF(*kept, *added)

    staged = write_stage(rows.withColumn("row", F.monotonically_increasing_id()), new_stage_path(spark, "texts"))
    hits = None
    for part in range(parts):
        found = staged.select("data", "row").mapInArrow(_match(automaton(part), ["row"], True), f"row long, {_FOUND}")
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy("row").agg(
        _joined_spans(F.collect_list("spans")).alias("spans_m"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items_m"),
        F.max("longest").alias("longest_m"),
    )
    # An automaton of nothing counts the words.
    blank = spark.sparkContext.broadcast(pickle.dumps(SuffixAutomaton(window).finish()))
    counted = staged.mapInArrow(_match(blank, [*names, "row"], False), ", ".join([*kinds, "row long", _FOUND]))
    joined = counted.join(merged, "row", "left")
    best = (F.coalesce(f"{c}_m", c).alias(c) for c in added[1:])
    return joined.select(*names, "n_words", *best).toDF(*kept, *added)


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _cut(data: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    ends = [(m.start(), m.end()) for m in _WORD.finditer(data)]
    out, at = [], 0
    for span in spans:
        out.append(data[at : ends[span["first"]][0]])
        at = ends[span["end"] - 1][1]
    return b"".join((*out, data[at:]))


def _remove(at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [c.as_py() for c in batch.column(at)]
            spans = batch.column(at + 1).to_pylist()
            texts = [c if not s else _cut(c, s) for c, s in zip(cells, spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(texts, pa.binary())], names=[*names, "text"])

    return run


def remove_overlaps(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    min_span: int = WINDOW,
    max_coverage: float = 0.5,
    text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents without passages of test items.

    A document of whose words more than ``max_coverage`` lie in spans goes
    whole; from the others the spans of ``min_span`` words and more are cut out.
    All other columns stay, a null text stays null; see ``find_overlaps``.
    """
    kept = list(docs.columns)
    names = [f"c{k}" for k in range(len(kept))]
    at = kept.index(text_col)
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)))
    found = find_overlaps(plain, items, window, text_col=names[at], **options)
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    long_spans = F.filter("spans", lambda s: s["end"] - s["first"] >= min_span)
    others = [n for n in names if n != names[at]]
    left = found.where(covered <= F.lit(max_coverage) * F.col("n_words")).select(
        *others, F.col(names[at]).cast("binary").alias("data"), long_spans.alias("cut")
    )
    kinds = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(names, kept) if n in others)
    cleaned = left.mapInArrow(_remove(len(others), others), f"{kinds}, text binary" if others else "text binary")
    return cleaned.select(
        *(F.col("text").cast("string").alias(text_col) if n == names[at] else F.col(n).alias(c) for n, c in zip(names, kept))
    )
