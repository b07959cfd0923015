"""The pipeline against the same stages written plainly, and its edge cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from citeloom.llm import toxicity
from citeloom.llm.queries import RANKS
from citeloom.llm.vocabulary import read_ranks

_DOCS = "doc_id long, text string, lang string, source string, n_chars long, words int, others string"


def _table(spark, path):
    draw = random.Random(21)
    words = ["".join(draw.choice("abcdefghijklmnoé") for _ in range(draw.randint(2, 8))) for _ in range(400)]
    passage = " ".join(draw.choice(words) for _ in range(60))
    rows, labels = [], []
    for i in range(240):
        text = " ".join(draw.choice(words) for _ in range(draw.randint(5, 120)))
        if i % 8 == 0:
            text += ". You stupid moron! " + draw.choice(words)
        if i % 7 == 3:
            text = text + "\n" + passage + " " + draw.choice(words)
        if i % 11 == 5:
            text = rows[i - 2][1]
        labels.append((i, int("moron" in text)))
        rows.append((i, text, "en", draw.choice(["src0", "src0", "src1", "é", None])))
    rows += [(900, None, None, "src1"), (901, "", "de", "src1"), (902, " \t", "de", None)]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 3, "clash") for r in rows], _DOCS)
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def _print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _plain_near(rows):
    label = list(range(len(rows)))
    prints = [_print(r[1]) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    least = {}
    for r, x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, r[0]), r[0])
    return [r for r, x in zip(rows, label, strict=True) if r[0] == least[x]]


def _plain_cut(rows, span=50):
    first = {}
    for i, text, *_ in rows:
        data = (text or "").encode()
        for at in range(len(data) - span + 1):
            first[data[at : at + span]] = min(first.get(data[at : at + span], i), i)
    out = []
    for i, text, *rest in rows:
        data = (text or "").encode()
        gone = set()
        for at in range(len(data) - span + 1):
            if first[data[at : at + span]] < i:
                gone.update(range(at, at + span))
        kept, at = "", 0
        for char in text or "":
            size = len(char.encode())
            kept += "" if gone & set(range(at, at + size)) else char
            at += size
        out.append((i, kept, *rest))
    return out


def _plain_mix(rows):
    size = lambda t: len(t.encode().split())
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size(r[1]) for r in rows if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, free, left = {}, set(sources), float(sum(total.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * total[s]}
        if not above:
            target.update(share)
            break
        target.update({s: 3.0 * total[s] for s in above})
        left -= sum(target[s] for s in above)
        free -= above
    reads = []
    for s in sources:
        quota, start = round(target[s]), 0
        full, rest = divmod(quota, total[s]) if total[s] else (0, 0)
        mine = [r for r in rows if r[3] == s]
        for r in sorted(mine, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0])):
            n = size(r[1])
            last = max(0, min(n, rest - start))
            reads += [(r[0], r[1])] * (full if n else 0)
            if last:
                data = r[1].encode()
                end = 0
                for word in data.split()[:last]:
                    end = data.index(word, end) + len(word)
                reads.append((r[0], r[1] if last == n else data[:end].decode()))
            start += n
    return reads


def test_run_equals_plain_stages(spark, tmp_path):
    rows = _table(spark, tmp_path)
    got = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.learn(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    codes = toxicity._Codes(model.grammar)
    scores = model.scores(np.array([model.grammar.features(r[1] or "", codes) for r in rows]))
    clean = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    assert {r[0] for r in rows if "moron" in (r[1] or "")} == {r[0] for r in rows} - {r[0] for r in clean}
    kept = _plain_cut(_plain_near(clean))
    encoder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={}
    )
    want = []
    for i, text in _plain_mix(kept):
        ids = encoder.encode_ordinary(text)
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((i, len(ids), listed, hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert len(kept) < len(clean) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    _table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        assert out.where("words <> 3 OR others <> 'clash'").count() == 0
        assert out.where("n_chars <> coalesce(char_length(text), 0)").count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages_take_an_empty_table(spark, tmp_path, k):
    _table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("false")
    assert corpus_pipeline.STAGES[k][1](spark, docs, str(tmp_path)).count() == 0


def test_stages_with_repeated_rows_long_texts_and_clashing_names(spark, tmp_path):
    _table(spark, tmp_path)
    long = " ".join(f"w{k}" for k in range(150_000))
    calm = ["a first calm line of words", "and quite another one here", None, "", " \n"]
    rows = [(i, t, "en", s) for i, (t, s) in enumerate(zip(calm, ["a", "b", None, "a", "b"], strict=True))]
    rows += [rows[0]] * 3 + [(None, "no id has this text", "en", None)] * 2 + [(50, long, "en", "a"), (51, long + " end", "en", "a")]
    clash = ("score", "predicted", "kept", "size", "chosen", "component", "text_hash", "position", "start", "id", "key")
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in clash)
    docs = spark.createDataFrame([(*r, len(r[1] or ""), *clash) for r in rows], kinds).repartition(2)
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        assert out.where(" OR ".join(f"coalesce(`{c}`, '') <> '{c}'" for c in clash)).count() == 0
        texts[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    given = [(r[0], r[1]) for r in rows]
    # No label belongs to a toxic one here, and nothing in them is.
    assert texts["toxicity"] == sorted(given, key=str)
    one = [(0, calm[0]), (1, calm[1]), (2, None), (None, "no id has this text"), (None, "no id has this text"), (50, long)]
    assert texts["simhash near-dedup"] == sorted(one, key=str)
    cut = {**dict(given), 2: "", 51: " end"}
    assert texts["suffix-array dedup"] == sorted(((i, cut[i]) for i, _ in given), key=str)
    read = texts["mixing"]
    assert {t for _, t in read} and all((t or "").strip() for _, t in read)
    # Words taken, over all sources, are the words given.
    assert sum(len(t.split()) for _, t in read) == sum(len((t or "").split()) for _, t in given)
    tokens = corpus_pipeline.tokenize(spark, docs, "").collect()
    assert len(tokens) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert [r.decoded_sha256 for r in tokens if r.doc_id in (2, 3)] == [empty, empty]
    assert {r.decoded_sha256 for r in tokens if r.doc_id == 50} == {hashlib.sha256(long.encode()).hexdigest()}


def test_one_row_of_a_component_stays_where_ids_repeat(spark):
    rows = [
        (1, "alpha beta gamma delta"), (1, "ALPHA beta gamma delta"), (1, "ALPHA beta gamma delta"),
        (2, "some other words stand here"), (5, "SOME other words stand here"), (5, "a quite different line of text"),
        (7, None), (7, ""), (None, "Alpha beta gamma delta"), (None, "Alpha beta gamma delta"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").collect()]
    one = min(rows[:2], key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())
    want = [one, rows[3], rows[5], rows[6], rows[8], rows[9]]
    assert sorted(got, key=str) == sorted(want, key=str)
