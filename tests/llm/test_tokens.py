"""BPE against the public encoder; token counts against a plain greedy matcher."""

import hashlib
import pickle
import random

import public_tokenizers
import pytest
import tiktoken

from citeloom.llm import bpe, token_counts
from citeloom.llm.queries import RANKS
from citeloom.llm.vocabulary import read_ranks, word_segments


@pytest.fixture(scope="module")
def codec():
    return bpe.load_codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def expected():
    ranks = read_ranks(RANKS)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _texts():
    draw = random.Random(3)
    signs = "abcde é\n\t  '\x1c\x85　sЖ漢9²٣½😀.,$-<|>"
    made = ["".join(draw.choice(signs) for _ in range(draw.randrange(60))) for _ in range(1500)]
    return [*made, "", " ", "  x", "x  ", "\n x", "<|endoftext|>", "it's  we'll", "ab" * 40_000, " " * 3000]


def test_ids_and_decoded_bytes(codec, expected):
    for text in _texts():
        ids = [i for part in codec.encode(text) for i in part]
        assert ids == expected.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_parts_change_nothing(codec, expected, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 7)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = pickle.loads(pickle.dumps(codec))
    for text in _texts()[:400]:
        assert [i for part in small.encode(text) for i in part] == expected.encode_ordinary(text)


def test_words_that_punctuation_ends_are_cut_without_the_pattern(codec, expected):
    draw = random.Random(5)
    ends = [".", ",", "'", "'.", "...", "!?", '"', "'s", "'s.", "\u2019", "9.", ""]
    words = ["the", "Esores", "zz\u00e9qu", "don't", "x"]
    text = " ".join(draw.choice(words) + draw.choice(ends) for _ in range(2000))
    assert [i for part in codec.encode(text) for i in part] == expected.encode_ordinary(text)
    own = pickle.loads(pickle.dumps(codec))
    own.find = None
    text = "Zzqu, esores. zzesores!? the..."
    assert [i for part in own.encode(text) for i in part] == expected.encode_ordinary(text)
    other = bpe.Codec(read_ranks(RANKS), r"\p{L}+[.]| ?\p{L}+|[^\p{L}]+|\s+")
    assert not other.marks


def test_perfect_hash_is_minimal():
    table = {f"key{i}".encode(): i for i in range(5000)}
    index = bpe.PerfectHash(table)
    assert sorted(k for k in index.keys if k is not None) == sorted(table)
    assert all(index.get(k) == v for k, v in table.items())
    assert index.get(b"other") is None
    assert bpe.PerfectHash({}).get(b"") is None


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="single byte"):
        bpe.Codec({b"a": 0}, ".")


def test_round_trip_rows(spark, codec, expected):
    rows = [(1, "Hello  world", 5), (1, "Hello  world", 5), (None, None, 0), (2, "", 1), (3, "é" * 5000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    got = sorted(map(tuple, bpe.round_trip(df, codec).collect()), key=str)
    want = []
    for i, text, _ in rows:
        ids = expected.encode_ordinary(text or "")
        want.append(
            (
                i,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert got == sorted(want, key=str)
    assert bpe.round_trip(df.where("false"), codec).count() == 0
    ids = {r.doc_id: r.ids for r in bpe.encode_column(df, codec).collect()}
    assert ids[3] == expected.encode_ordinary("é" * 5000) and ids[None] == []


def _greedy(word, start, rest):
    tokens, at, pieces = 0, 0, start
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        tokens, at, pieces = tokens + 1, end, rest
    return tokens


def test_longest_match_on_random_vocabularies():
    draw = random.Random(8)
    for _ in range(200):
        word = lambda n: bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, n)))
        start = {word(6) for _ in range(draw.randrange(1, 12))}
        rest = {word(6) for _ in range(draw.randrange(1, 12))}
        automaton = token_counts.LongestMatch(start, rest)
        for _ in range(60):
            text = word(14)
            assert automaton.count(text) == _greedy(text, start, rest), (start, rest, text)
    assert token_counts.LongestMatch({b"a"}, {b"b"}).count(b"") == 0


def test_token_counts_rows(spark):
    start, rest = token_counts.word_pieces(RANKS)
    rows = [(1, "the cat\tsat \n on"), (1, "the cat\tsat \n on"), (None, None), (2, ""), (3, "zzqé " * 3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got = sorted(map(tuple, token_counts.count_tokens(df, RANKS).collect()), key=str)
    want = []
    for i, text in rows:
        words = (text or "").encode().split()
        want.append((i, len((text or "").encode()), len(words), sum(_greedy(w, start, rest) for w in words)))
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(df.where("false"), RANKS).count() == 0


def test_long_words_are_counted_and_not_remembered():
    counts = token_counts._Counts(token_counts.LongestMatch([b"ab", b"a", b"b"], [b"ab", b"a", b"b"]))
    assert counts[b"ab" * 300_000] == 300_000 and counts[b"aba"] == 2
    assert list(counts) == [b"aba"]


def test_segments_cut_at_spaces_only():
    data = b"aa bb  cc " * 50 + b"d" * 100 + b" e"
    parts = list(word_segments(data, 16))
    assert b"".join(parts) == data
    assert [w for p in parts for w in p.split()] == data.split()
