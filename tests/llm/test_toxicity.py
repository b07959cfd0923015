"""The clause grammar: composed machine against its parts, and what it learns."""

import math
import random
import re

import numpy as np
import pytest

from citeloom.llm import toxicity


def _kinds(text, grammar=None):
    grammar = grammar or toxicity.Grammar()
    counts = grammar.count_clauses(text, toxicity._Codes(grammar))
    kinds = toxicity.clause_kinds()
    return {kinds[k]: int(n) for k, n in enumerate(counts[:-1]) if n}


def test_clauses():
    meant, told, denied = toxicity.MEANT, toxicity.TOLD, toxicity.DENIED
    assert _kinds("You are an idiot.") == {(meant, 0, True): 1}
    assert _kinds("An idiot, you see.") == {(meant, 0, False): 1}
    assert _kinds("He is not an idiot.") == {(denied, 0, True): 1}
    assert _kinds("Not in all of the long years an idiot.") == {(meant, 0, False): 1}
    assert _kinds("He said idiot!") == {(told, 0, True): 1}
    assert _kinds("He said so. Idiot") == {(meant, 0, False): 1}
    assert _kinds("I kill you, moron; nice day") == {(0, meant, True): 1, (meant, 0, False): 1}
    assert _kinds("A nice day.") == _kinds("") == _kinds(" \n") == {}
    assert _kinds("IDIOT### clown|x") == {(meant, 0, False): 1}


def test_composition_equals_the_chain():
    moves, outputs = toxicity.compose(toxicity.SCOPE, toxicity.CLAUSE, range(7))
    draw = random.Random(2)
    for _ in range(300):
        state, one, two = 0, toxicity.SCOPE.start, toxicity.CLAUSE.start
        for _ in range(30):
            symbol = draw.randrange(7)
            one, middle = toxicity.SCOPE.step(one, symbol)
            two, out = toxicity.CLAUSE.step(two, middle)
            assert outputs[state][symbol] == out
            state = moves[state][symbol]


def test_parts_change_nothing(monkeypatch):
    text = "You are not a moron, idiot. He said\nscum and trash; " * 30
    whole = _kinds(text)
    monkeypatch.setattr(toxicity, "PART", 11)
    assert _kinds(text) == whole


def _plain_score(text, stems, weights, bias):
    """The same score without machines: clauses cut at their ends, mentions judged by the words before."""
    found, clauses = {k: 0 for k in toxicity.clause_kinds()}, [[]]
    for token in (text or "").lower().split():
        words = re.findall(r"[^\W\d_]+", token)
        kinds = set()
        for w in words:
            if w in toxicity.INSULTS or any(w.startswith(s) for s in stems):
                kinds.add("insult")
            for kind, listed in (("threat", toxicity.THREATS), ("no", toxicity.NEGATIONS), ("told", toxicity.REPORTED), ("target", toxicity.TARGETS)):
                if w in listed and w not in toxicity.INSULTS and "insult" not in kinds:
                    kinds.add(kind)
        order = ("insult", "threat", "no", "told", "target")
        clauses[-1].append(next((k for k in order if k in kinds), ""))
        if token[-1] in ".!?;:,":
            clauses.append([])
    for clause in clauses:
        meant = {"insult": 0, "threat": 0}
        for at, kind in enumerate(clause):
            if kind in meant:
                denied, told = "no" in clause[max(0, at - 3) : at], "told" in clause[:at]
                how = toxicity.DENIED if denied else toxicity.TOLD if told else toxicity.MEANT
                meant[kind] = max(meant[kind], how)
        if any(meant.values()):
            found[meant["insult"], meant["threat"], "target" in clause] += 1
    n = sum(c for (i, t, _), c in found.items() if toxicity.MEANT in (i, t))
    x = [math.log1p(c) for c in found.values()]
    x += [float(n > 0), math.log1p(n), math.log1p(100 * n / len(clauses))]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(x, weights, strict=True)) + bias)))


def test_scores_equal_the_plain_ones(spark):
    draw = random.Random(11)
    stems = ("grumf", "zor")
    weights = np.random.default_rng(4).standard_normal(len(toxicity.clause_kinds()) + 3)
    model = toxicity.Model(toxicity.Grammar(stems), weights, -0.7)
    words = ["calm", "day", "grumfel", "zorro", "you", "She", "not", "nie", "said", "dit", "kill", "Tuer", "IDIOT", "basura", "crétin"]
    words += ["a", "house", "you-idiot", "no.", "said:", "kill!", "trash,", "x1y", "###", "42", "?", "pas;"]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 60))) for _ in range(400)]
    texts += [None, "", " \n\t", "idiot" * 40_000, "you " * 90_000 + "idiot", "not\u00a0an idiot", "ÉTÉ kill"] + texts[:5]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, predicted int")
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    for i, text in enumerate(texts):
        want = _plain_score(text, stems, weights, -0.7)
        assert got[i].score == pytest.approx(want, abs=1e-9), text and text[:200]
        assert got[i].predicted == int(got[i].score >= 0.5)


def test_long_words_are_not_remembered():
    codes = toxicity._Codes(toxicity.Grammar())
    assert codes["idiot"] == toxicity.INSULT and codes["b" * 500_000 + "!"] == 8
    assert list(codes) == ["idiot"]


def test_more_stems_than_ever_asked_for():
    # Each of 300 stems explains ten rows of its own.
    present = [([k], 1) for k in range(300) for _ in range(10)] + [([], 0)] * 50
    stems = [f"s{k:03}" for k in range(300)]
    assert sorted(toxicity.choose_stems(present, stems)) == stems


def test_weights_separate():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 3))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    weights, bias = toxicity.fit_weights(x, y)
    assert ((x @ weights + bias > 0) == (y == 1)).mean() > 0.97


def test_greedy_stems():
    present = [([0, 1], 1)] * 10 + [([1], 0)] * 9 + [([2], 1)] * 6 + [([], 0)] * 20
    assert toxicity.choose_stems(present, ["idio", "the", "scu"]) == ["idio", "scu"]
    assert toxicity.choose_stems(present, []) == []


@pytest.mark.parametrize("parts", [1, 4])
def test_stem_counts_do_not_depend_on_partitions(spark, parts):
    rows = [("calm grumfel day", 0)] * 9 + [("a grumfel here", 1)] * 4 + [("day by day", 0)] * 3
    training = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "text string, toxic int")
    got = {r.stem: (r.seen, r.toxic) for r in toxicity._stem_counts(training).collect()}
    assert got["grumfel"] == got["gru"] == (13, 4)
    assert got["day"] == (12, 0)


def test_learns_stems_and_holds_out(spark):
    draw = random.Random(5)
    calm = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(900):
        words = [draw.choice(calm) for _ in range(40)]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(2):
                words[draw.randrange(40)] = "grumf" + draw.choice(["el", "a", "isch", "ot"])
        rows.append((i, " ".join(words) + ".", 1))
        labels.append((i, None if i % 50 == 7 else int(toxic), 0))
    rows += [(5000, None, 0), (5001, "", 0), (None, "You idiot", 0), (7, "a", 0), (7, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (1, 0, 0)], "doc_id long, toxic int, text int")
    got = toxicity.score_documents(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    truth = {i: t for i, t, _ in labels if t is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id != 7]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    model = toxicity.learn(docs, marks)
    assert any(s.startswith("grumf"[: len(s)]) for s in model.grammar.stems)
    assert toxicity.score_documents(docs.where("false"), marks).count() == 0


@pytest.mark.parametrize("value", [0, 1, None])
def test_labels_of_one_kind_give_the_default(spark, value):
    docs = spark.createDataFrame([(i, "you idiot") for i in range(20)] + [(99, "a calm day")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, value) for i in range(20)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, marks).collect()}
    assert got[3] == 1 and got[99] == 0


def test_score_keeps_columns(spark):
    df = spark.createDataFrame([(1, "idiot", 5.0, ["x"])], "doc_id long, text string, score double, tags array<string>")
    out = toxicity.score(df, toxicity.default_model())
    assert out.columns == ["doc_id", "text", "tags", "score", "predicted"]
    assert out.first().tags == ["x"]


def test_stems_are_sent_before_they_are_many(spark, monkeypatch):
    rows = [(f"grumfel{chr(97 + k % 26)} {chr(97 + k % 26) * 5}", int(k % 4 == 0)) for k in range(60)]
    training = spark.createDataFrame(rows, "text string, toxic int").coalesce(1)
    wanted = {tuple(r) for r in toxicity._stem_counts(training).collect()}
    monkeypatch.setattr(toxicity, "COUNTED_STEMS", 20)
    assert {tuple(r) for r in toxicity._stem_counts(training).collect()} == wanted


def test_the_text_is_sent_once_and_scored_in_parts(spark, monkeypatch):
    texts = ["you idiot", None, "", "a calm day", "they said you are scum"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    model = toxicity.default_model()
    wanted = toxicity.score(docs, model).orderBy("doc_id").collect()
    monkeypatch.setattr(toxicity, "SCORED_ROWS", 2)
    got = toxicity.score(docs, model)
    assert got.orderBy("doc_id").collect() == wanted
    assert "AS read" not in got._jdf.queryExecution().analyzed().toString()
