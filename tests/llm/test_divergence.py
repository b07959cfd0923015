"""Source audit against exact arithmetic on plain counts."""

import random
import re
from collections import Counter

import pytest

from citeloom.llm import divergence as dv

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in _TERM.findall(text or "")]


def _brute(docs, min_docs, top):
    docs = [(_terms(t), lang or "", source or "") for t, lang, source in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        held = Counter(t for terms, _, _ in mine for t in set(terms))
        kept = [t for t, n in held.items() if n >= min_docs]

        def shares(of, kept=kept, mine=mine):
            seen = Counter(t for terms, _, s in mine if of in (None, s) for t in terms)
            total = sum(seen[t] for t in kept)
            return seen, {t: 1 + 10**9 * (seen[t] + 2) // (total + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        _, of_lang = shares(None)
        groups = {s: shares(s) for s in {d[2] for d in mine}}
        for source, (seen, p) in groups.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), other) for other, (_, q) in groups.items() if other != source]
            terms = [(f(p[t], of_lang[t]), t) for t in kept if seen[t] and p[t] > of_lang[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, i, v, r + 1) for r, (v, i) in enumerate(found[:most])]
    return sorted(out)


def _corpus():
    draw = random.Random(6)
    vocab = [f"{a}{b}" for a in "abcÉé" for b in "xyzÄ日\U0001f600"]
    docs = []
    for _ in range(250):
        source = draw.choice(["s1", "s1", "s1", "s2", "é", "z\U0001f600", None, ""])
        lean = vocab[: 8 + 3 * len(source or "")]
        docs.append(("-".join(draw.choice(lean + vocab[:4]) for _ in range(draw.randrange(0, 25))), draw.choice(["en", "de", None]), source))
    docs += [(None, "en", "bare"), ("", "en", "bare2"), ("12 3!", "en", "bare3"), ("only", "one", "src"), (None, "none", "a"), ("", "none", "b")]
    docs += [docs[0]] * 12 + [("CASE Case case Ä ä " * 3, "en", "s1")] * 11
    return docs


@pytest.mark.parametrize(("min_docs", "top"), [(10, 10), (3, 2), (1000, 10)])
def test_equals_exact_counts(spark, min_docs, top):
    docs = _corpus()
    table = spark.createDataFrame([(*d, "clash", 1) for d in docs], "text string, lang string, source string, term string, n int")
    got = dv.audit_sources(table, min_docs=min_docs, top=top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == _brute(docs, min_docs, top)


def test_an_empty_table(spark):
    assert dv.audit_sources(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_counts_are_handed_on_in_bounded_portions(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(dv, "COUNTS_HELD", 5)
    texts = ["a b c d a", "b c", "x" * 100, "Ab e f g h i", None, "long " * 1000]
    batch = pa.RecordBatch.from_pydict(
        {"lang": ["l"] * 6, "source": ["s", "t"] * 3, "data": pa.array([t and t.encode() for t in texts], pa.binary())}
    )
    out = list(dv._count(iter([batch])))
    assert len(out) > 2
    seen, held = Counter(), Counter()
    for part in out:
        for row in part.to_pylist():
            seen[row["source"], row["term"].decode()] += row["n"]
            held[row["source"], row["term"].decode()] += row["docs"]
    want = Counter((s, t) for s, text in zip("ststst", texts) for t in _terms(text))
    assert seen == want
    assert held == Counter((s, t) for s, text in zip("ststst", texts) for t in set(_terms(text)))


def test_a_very_long_text_is_one_document(spark):
    text = "alpha beta " * 500_000
    docs = [(text, "en", "a"), ("beta", "en", "b")]
    got = dv.audit_sources(spark.createDataFrame(docs, "text string, lang string, source string"), min_docs=1)
    assert sorted(map(tuple, got.collect())) == _brute(docs, 1, 10)
