"""Overlap with test items against a search for every window."""

import random
import re

import pytest

from citeloom.llm import decontamination as dc

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return _WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def _brute(text, items, window):
    words = _words(text)
    hit, whose = set(), set()
    for item, its in items:
        its = _words(its)
        n = min(window, len(its))
        grams = {tuple(its[k : k + n]) for k in range(len(its) - n + 1)} if n else set()
        for k in range(len(words) - n + 1):
            if n and tuple(words[k : k + n]) in grams:
                hit.update(range(k, k + n))
                whose.add("" if item is None else str(item))
    return len(words), sorted(hit), sorted(whose)


def _spread(spans):
    return [w for s in spans for w in range(s["first"], s["end"])]


def _corpus(seed):
    draw = random.Random(seed)
    vocab = ["a", "b", "c", "dé", "Éa", "f9"]
    say = lambda n: " ".join(draw.choice(vocab) for _ in range(n))
    items = [(k, say(draw.randrange(1, 14))) for k in range(40)]
    items += [(3, say(9)), (None, say(6)), (77, None), (78, ""), (79, "?!"), (80, items[0][1]), (81, "a " * 40)]
    docs = [say(draw.randrange(0, 60)) for _ in range(60)]
    docs += [None, "", " .,;", "A-B_C\x00dé ÉA", "x" * 5000, items[5][1].upper(), "a " * 300, docs[0], docs[0]]
    return items, docs


@pytest.mark.parametrize(("window", "sizes"), [(4, {}), (6, {}), (5, {"automaton_words": 40, "piece_words": 12})])
def test_equals_a_search_for_every_window(spark, window, sizes):
    items, docs = _corpus(window)
    table = spark.createDataFrame([(k % 50 or None, t, "clash", 1) for k, t in enumerate(docs)], "doc_id long, text string, items string, c0 int")
    tests = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, part int")
    got = dc.find_overlaps(table, tests, window, **sizes).collect()
    assert len(got) == len(docs)
    want = sorted((t or "", *_brute(t, items, window)) for t in docs)
    assert sorted((r.text or "", r.n_words, _spread(r.spans), r["items"]) for r in got) == want
    for r in got:
        assert all(a["end"] < b["first"] for a, b in zip(r.spans, r.spans[1:]))
        assert r.longest <= max([0, *(s["end"] - s["first"] for s in r.spans)])


def test_automaton_holds_exactly_the_substrings():
    draw = random.Random(4)
    texts = [(str(k), [draw.choice([b"x", b"y", b"z"]) for _ in range(draw.randrange(1, 12))]) for k in range(25)]
    automaton = dc.SuffixAutomaton(3)
    automaton.add(texts)
    automaton.finish()
    inside = {tuple(t[a:b]) for _, t in texts for a in range(len(t)) for b in range(a + 1, len(t) + 1)}
    for _ in range(3000):
        asked = tuple(draw.choice([b"x", b"y", b"z"]) for _ in range(draw.randrange(1, 8)))
        state = 0
        for word in asked:
            state = automaton.step(state, automaton.numbers[word]) if state >= 0 else -1
        assert (state >= 0) == (asked in inside)
    assert len(automaton.length) <= 2 * sum(len(t) for _, t in texts) + 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    tests = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    (row,) = dc.find_overlaps(docs, tests.where("false")).collect()
    assert (row.n_words, row.spans, row["items"], row.longest) == (3, [], [], 0)
    assert dc.find_overlaps(docs.where("false"), tests).count() == 0
    assert dc.find_overlaps(docs.where("false"), tests.where("false")).count() == 0


def test_a_very_long_text(spark):
    passage = " ".join(f"w{k}" for k in range(30))
    text = "filler words " * 400_000 + passage + " more" * 400_000  # more than one segment
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    tests = spark.createDataFrame([(9, passage)], "item_id long, text string")
    (row,) = dc.find_overlaps(docs, tests, columns=("doc_id",)).collect()
    assert row.asDict(True) == {
        "doc_id": 1, "n_words": 1_200_030, "spans": [{"first": 800_000, "end": 800_030}], "items": ["9"], "longest": 30,
    }


def test_spans_go_and_covered_documents_go_whole(spark):
    passage = "One two, three four; five six seven eight nine ten ELEVEN"
    docs = [
        (1, f"Keep this. {passage}! And this too, with some more words so that most of it is clean.", "en"),
        (2, f"so {passage}", "en"),
        (3, None, "en"),
        (4, "nothing to see", None),
        (5, "", "en"),
    ]
    table = spark.createDataFrame(docs, "doc_id long, text string, spans string")
    tests = spark.createDataFrame([(1, passage.lower())], "item_id long, text string")
    got = {r.doc_id: r for r in dc.remove_overlaps(table, tests).collect()}
    assert set(got) == {1, 3, 4, 5}
    assert got[1].text == "Keep this. ! And this too, with some more words so that most of it is clean."
    assert (got[3].text, got[4].text, got[5].text, got[4].spans, got[1].spans) == (None, "nothing to see", "", None, "en")
    loose = {r.doc_id: r.text for r in dc.remove_overlaps(table, tests, min_span=12, max_coverage=1.0).collect()}
    assert loose[2] == docs[1][1] and len(loose) == 5
