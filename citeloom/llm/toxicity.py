"""Toxicity from a weighted finite-state grammar of clauses."""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.sources.staged import new_stage_path, write_stage

#: Labelled rows from which stems and weights are learned, at most.
TRAINING_ROWS = 20_000
#: Letters of the word beginnings that may become insult stems.
STEM_LETTERS = range(3, 11)
#: Words after a negation that it covers.
NEGATION_REACH = 3
#: Tokens remembered by a worker before it starts anew, and the letters of a token worth it.
REMEMBERED_TOKENS, REMEMBERED_LETTERS = 100_000, 64
#: Characters read at a time, stems sent at a time, stems counted before they are sent, texts scored at a time.
PART, STEM_ROWS, COUNTED_STEMS, SCORED_ROWS = 1 << 20, 1 << 16, 1 << 17, 1 << 10

# Starting words of the classes, in English, German, French and Spanish.
INSULTS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless",
    "disgusting", "imbecile", "vermin", "filth", "dumb", "dummkopf", "abschaum", "crétin", "ordure",
    "estúpido", "basura",
)
THREATS = (
    "kill", "hurt", "destroy", "shoot", "stab", "strangle", "umbringen", "töten", "tuer", "frapper",
    "matar", "golpear",
)
TARGETS = (
    "you", "your", "they", "them", "he", "she", "people", "du", "ihr", "dich", "euch", "sie", "tu",
    "vous", "ils", "elles", "tú", "usted", "ellos", "ellas",
)
NEGATIONS = ("not", "no", "never", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca")
REPORTED = (
    "said", "says", "called", "quoted", "reported", "sagte", "nannte", "dit", "disait", "dijo", "llamó",
)
CLAUSE_ENDS = ".!?;:,"

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
#: How a mention is meant: denied, told of another's speech, or meant by the writer.
DENIED, TOLD, MEANT = 1, 2, 3

Symbol = int | tuple[int, int]


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) gives the next state and an output."""

    start: object
    step: Callable[[object, Symbol], tuple[object, object]]


def _scope(state: tuple[int, bool], symbol: int) -> tuple[tuple[int, bool], Symbol]:
    reach, told = state
    if symbol == END:
        return (0, False), END
    if symbol == NEGATION:
        return (NEGATION_REACH, told), OTHER
    if symbol == REPORT:
        return (max(reach - 1, 0), True), OTHER
    meaning = DENIED if reach else TOLD if told else MEANT
    out = (symbol, meaning) if symbol in (INSULT, THREAT) else symbol
    return (max(reach - 1, 0), told), out


def _clause(state: tuple[int, int, bool], symbol: Symbol) -> tuple[tuple, tuple | None]:
    insult, threat, target = state
    if symbol == END:
        return (0, 0, False), (state if insult or threat else None)
    if symbol == TARGET:
        return (insult, threat, True), None
    if isinstance(symbol, tuple):
        kind, meaning = symbol
        if kind == INSULT:
            return (max(insult, meaning), threat, target), None
        return (insult, max(threat, meaning), target), None
    return state, None


#: Marks each mention by the negation or reported speech that covers it.
SCOPE = Transducer((0, False), _scope)
#: Joins the mentions of a clause, and gives what the clause says at its end.
CLAUSE = Transducer((0, 0, False), _clause)


def compose(first: Transducer, second: Transducer, symbols: range) -> tuple[list[list[int]], list[list]]:
    """The machine that feeds ``first``'s output to ``second``, as tables over the states it reaches."""
    numbers = {(first.start, second.start): 0}
    queue = deque(numbers)
    moves: list[list[int]] = []
    outputs: list[list] = []
    while queue:
        one, two = queue.popleft()
        moves.append([])
        outputs.append([])
        for symbol in symbols:
            next_one, middle = first.step(one, symbol)
            next_two, out = second.step(two, middle)
            pair = (next_one, next_two)
            if pair not in numbers:
                numbers[pair] = len(numbers)
                queue.append(pair)
            moves[-1].append(numbers[pair])
            outputs[-1].append(out)
    return moves, outputs


def clause_kinds() -> list[tuple[int, int, bool]]:
    """Every kind of matched clause: how insult and threat are meant, and whether someone is addressed."""
    return [
        (insult, threat, target)
        for insult in range(4)
        for threat in range(4)
        for target in (False, True)
        if insult or threat
    ]


_WORDS = re.compile(r"[^\W\d_]+").findall


class Grammar:
    """The lexical transducer with the composed scope and clause transducers behind it."""

    def __init__(self, stems: tuple[str, ...] = ()) -> None:
        self.words = {
            **dict.fromkeys(TARGETS, TARGET),
            **dict.fromkeys(REPORTED, REPORT),
            **dict.fromkeys(NEGATIONS, NEGATION),
            **dict.fromkeys(THREATS, THREAT),
            **dict.fromkeys(INSULTS, INSULT),
        }
        self.stems = frozenset(stems)
        self.letters = sorted({len(s) for s in stems})
        moves, outputs = compose(SCOPE, CLAUSE, range(END + 1))
        kinds = {kind: k for k, kind in enumerate(clause_kinds())}
        self.moves = moves
        self.outputs = [[-1 if o is None else kinds[o] for o in row] for row in outputs]
        self.kinds = len(kinds)

    def word_class(self, word: str) -> int:
        found = self.words.get(word, OTHER)
        if found != INSULT and any(word[:n] in self.stems for n in self.letters if len(word) >= n):
            return INSULT
        return found

    def token_code(self, token: str) -> int:
        """Class of a token without white space, plus 8 if a clause ends with it."""
        classes = set(map(self.word_class, _WORDS(token)))
        strongest = next((c for c in (INSULT, THREAT, NEGATION, REPORT, TARGET) if c in classes), OTHER)
        return strongest | (8 if token[-1] in CLAUSE_ENDS else 0)

    def count_clauses(self, text: str, codes: dict[str, int]) -> np.ndarray:
        """Matched clauses of a whole text by kind, and last the number of all clauses."""
        counts = np.zeros(self.kinds + 1)
        state, at = 0, 0
        moves, outputs = self.moves, self.outputs
        while at < len(text):
            stop = at + PART
            while stop < len(text) and not text[stop].isspace():
                stop += 1
            read = bytes(map(codes.__getitem__, text[at:stop].lower().split()))
            at = stop
            counts[-1] += sum(read.count(c | 8) for c in range(END))
            hits = any(read.count(c) for c in (INSULT, THREAT, INSULT | 8, THREAT | 8))
            if not hits and state == 0:
                # Only the clause still open can matter to the next part.
                read = read[max(read.rfind(c | 8) for c in range(END)) + 1 :]
            for code in read:
                state = moves[state][code & 7]
                if code & 8:
                    found = outputs[state][END]
                    if found >= 0:
                        counts[found] += 1
                    state = moves[state][END]
        found = outputs[state][END]
        if found >= 0:
            counts[found] += 1
        counts[-1] += 1
        return counts

    def features(self, text: str, codes: dict[str, int]) -> np.ndarray:
        counts = self.count_clauses(text, codes)
        kinds, clauses = counts[:-1], counts[-1]
        meant = sum(n for n, (i, t, _) in zip(kinds, clause_kinds(), strict=True) if MEANT in (i, t))
        return np.concatenate(
            (np.log1p(kinds), [float(meant > 0), np.log1p(meant), np.log1p(100 * meant / clauses)])
        )


class _Codes(dict):
    def __init__(self, grammar: Grammar) -> None:
        self.find = grammar.token_code

    def __missing__(self, token: str) -> int:
        found = self.find(token)
        if len(token) <= REMEMBERED_LETTERS:
            if len(self) >= REMEMBERED_TOKENS:
                self.clear()
            self[token] = found
        return found


@dataclass(frozen=True)
class Model:
    grammar: Grammar
    weights: np.ndarray
    bias: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -30, 30)))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


# Learning


def _beginnings(text: str) -> set[str]:
    words = set(_WORDS(text.lower()))
    return {w[:n] for w in words for n in STEM_LETTERS if len(w) >= n}


def _stem_counts(training: DataFrame) -> DataFrame:
    """In how many training texts, and toxic ones, a word begins so; counted in the task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, toxic = Counter(), Counter()

        def sent() -> Iterator[pa.RecordBatch]:
            # A stem may be toxic in another task, so all are sent.
            stems = iter(seen)
            while some := list(islice(stems, STEM_ROWS)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some),
                        pa.array([seen[s] for s in some], pa.int64()),
                        pa.array([toxic[s] for s in some], pa.int64()),
                    ],
                    ["stem", "seen", "toxic"],
                )

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                found = _beginnings(text.as_py())
                seen.update(found)
                if label.as_py():
                    toxic.update(found)
                if len(seen) >= COUNTED_STEMS:
                    yield from sent()
                    seen.clear()
                    toxic.clear()
        yield from sent()

    counted = training.select("text", "toxic").mapInArrow(run, "stem string, seen long, toxic long")
    return counted.groupBy("stem").agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic"))


def choose_stems(present: list[tuple[list[int], int]], candidates: list[str]) -> list[str]:
    """Stems that explain the toxic rows of the sample.

    Greedy: a row counts half as much with each stem it already holds, and a
    clean row counts against a stem twice. As many are chosen as explain rows
    enough.
    """
    if not candidates:
        return []
    toxic = [np.array(found, np.int64) for found, label in present if label]
    gain = np.zeros(len(candidates))
    holds: list[list[int]] = [[] for _ in candidates]
    for found, label in present:
        if not label:
            gain[found] -= 2
    for row, found in enumerate(toxic):
        gain[found] += 1
        for c in found.tolist():
            holds[c].append(row)
    worth = np.ones(len(toxic))
    least = max(4.0, 0.002 * len(toxic))
    chosen: list[str] = []
    # Halves add up exactly, so equal gains stay equal.
    while (top := gain.max()) >= least:
        best = max(np.flatnonzero(gain == top), key=lambda c: len(candidates[c]))
        chosen.append(candidates[best])
        for row in holds[best]:
            worth[row] /= 2
            gain[toxic[row]] -= worth[row]
        gain[best] = -np.inf
    return chosen


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.hstack((np.where(x.std(axis=0) > 0, x / scale, 0), np.ones((len(x), 1))))
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + penalty * w
        bend = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
        move = np.linalg.solve(bend, slope)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1])


def default_model() -> Model:
    """For want of labels of both kinds: what is meant by the writer counts, the rest hardly."""
    grammar = Grammar()
    kinds = [3.0 if MEANT in (i, t) else 0.5 for i, t, _ in clause_kinds()]
    return Model(grammar, np.array([*kinds, 2.0, 0.5, 0.2]), -3.0)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Stems and clause weights from a bounded sample of labelled rows that are not held out.

    The sample is the ``TRAINING_ROWS`` ids of smallest hash; equal texts count
    once. The ids are few enough to be broadcast. Every word beginning that the
    sample holds is weighed; nothing else bounds what is learned.
    """
    spark = docs.sparkSession
    chosen = (
        labels.select(id_col, label_col)
        .where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("labelled"))
        .agg(F.max(label_col).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(TRAINING_ROWS)
    )
    training = write_stage(
        docs.select(F.col(id_col), F.col(text_col).alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), F.col(id_col) == F.col("labelled"))
        .groupBy("text")
        .agg(F.max("toxic").alias("toxic")),
        new_stage_path(spark, "training-texts"),
    )
    rows, toxic = training.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < rows:
        return default_model()
    rate = toxic / rows
    strength = (F.col("toxic") - rate * F.col("seen")) / F.sqrt(rate * (1 - rate) * F.col("seen"))
    candidates = [
        r.stem
        for r in _stem_counts(training)
        .where((F.col("toxic") >= 4) & (F.col("toxic") > 0.6 * F.col("seen")))
        .withColumn("strength", strength)
        .where("strength >= 5")
        .orderBy(F.col("strength").desc(), "stem")
        .collect()
    ]
    number = {stem: k for k, stem in enumerate(candidates)}

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted(number[s] for s in _beginnings(t.as_py()) & number.keys()) for t in batch.column(0)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int64())), batch.column(1)], ["found", "toxic"]
            )

    present = training.select("text", "toxic").mapInArrow(holds, "found array<long>, toxic int").collect()
    grammar = Grammar(tuple(choose_stems([(r.found, r.toxic) for r in present], candidates)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(grammar)
        for batch in batches:
            found = [grammar.features(t.as_py(), codes).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column(1)], ["x", "toxic"])

    table = training.select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").collect()
    weights, bias = fit_weights(np.array([r.x for r in table]), np.array([r.toxic for r in table], float))
    return Model(grammar, weights, bias)


# Scoring


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns plus ``score`` and ``predicted`` for every whole text.

    A null or empty text matches nothing and gets the score of that; an empty
    table gives no rows. The names ``score`` and ``predicted`` are overwritten
    where the input has them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    wide = len(kept)
    # The text is sent once, unless it is a column that is overwritten.
    at = kept.index(text_col) if text_col in kept else wide

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        codes = _Codes(own.grammar)
        for whole in batches:
            for start in range(0, whole.num_rows, SCORED_ROWS):
                batch = whole.slice(start, SCORED_ROWS)
                x = np.array([own.grammar.features(t.as_py() or "", codes) for t in batch.column(at)])
                found = own.scores(x)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:wide], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=[*(f"c{k}" for k in range(wide)), "score", "predicted"],
                )

    inner = docs.select(
        *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)),
        *([] if at < wide else [F.col(text_col).alias("read")]),
    )
    kinds = ", ".join(f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(kept))
    return inner.mapInArrow(run, f"{kinds}, score double, predicted int").toDF(*kept, "score", "predicted")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``held_out``, ``score`` and ``predicted`` of every row, learned from ``labels``.

    Repeated rows and null ids give rows of their own (a null id counts as the
    empty string for ``held_out``); other columns are ignored.
    """
    model = learn(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return score(rows, model).select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
