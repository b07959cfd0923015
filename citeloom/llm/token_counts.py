"""Greedy longest-match token counts in linear time, without building pieces."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.vocabulary import read_ranks, word_segments

#: Words remembered by a worker before it starts anew, and the bytes of a word worth it.
REMEMBERED_WORDS, REMEMBERED_BYTES = 400_000, 64


class LongestMatch:
    """Trie over the pieces with failure links and popped-token counts.

    State ``u`` stands for the longest trie path that matches the text read so
    far. Where no edge fits, ``popped[u]`` pieces are final and ``fail[u]`` is
    where their remainder continues, so each byte is read once. ``start`` holds
    pieces that begin a word, ``rest`` pieces that continue one.
    """

    ROOT, REST = 0, 1

    def __init__(self, start: Iterable[bytes], rest: Iterable[bytes]) -> None:
        edges: dict[int, int] = {}
        final, children = [False, False], [[], []]
        for root, pieces in ((self.ROOT, start), (self.REST, rest)):
            for piece in pieces:
                node = root
                for byte in piece:
                    step = edges.get(node << 8 | byte)
                    if step is None:
                        step = len(final)
                        edges[node << 8 | byte] = step
                        final.append(False)
                        children.append([])
                        children[node].append(byte)
                    node = step
                if piece:
                    final[node] = True
        fail, popped = [-1] * len(final), [0] * len(final)
        queue = deque((self.ROOT, self.REST))
        while queue:
            parent = queue.popleft()
            for byte in children[parent]:
                node = edges[parent << 8 | byte]
                queue.append(node)
                if final[node]:
                    fail[node], popped[node] = self.REST, 1
                    continue
                back, count = fail[parent], popped[parent]
                while back >= 0 and back << 8 | byte not in edges:
                    count += popped[back]
                    back = fail[back]
                if back >= 0:
                    fail[node], popped[node] = edges[back << 8 | byte], count
        self.edges, self.fail, self.popped = edges, fail, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match; a word that cannot be matched is one unknown."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node, tokens = self.ROOT, 0
        for byte in word:
            step = edges.get(node << 8 | byte)
            while step is None:
                tokens += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                step = edges.get(node << 8 | byte)
            node = step
        while node != self.REST:
            tokens += popped[node]
            node = fail[node]
            if node < 0:
                return 1 if word else 0
        return tokens


class _Counts(dict):
    def __init__(self, automaton: LongestMatch) -> None:
        self.count = automaton.count

    def __missing__(self, word: bytes) -> int:
        found = self.count(word)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = found
        return found


def word_pieces(path: str) -> tuple[set[bytes], set[bytes]]:
    """A byte-level rank file read as word pieces.

    A leading space marks the piece as the beginning of a word; single bytes may
    stand anywhere, so every word can be matched.
    """
    ranks = read_ranks(path)
    single = {p for p in ranks if len(p) == 1}
    return {p[1:] for p in ranks if p[:1] == b" " and len(p) > 1} | single, {
        p for p in ranks if p[:1] != b" "
    } | single


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Words and greedy longest-match tokens of every whole text.

    Words are runs of bytes other than space and control white space. The
    automaton depends on the vocabulary file alone and is shipped to the tasks;
    texts stay where they are read, and very long ones are read whole, in
    segments that end at spaces. Result: id, ``n_bytes``, ``n_words``,
    ``n_tokens``. Null and empty texts have none; repeated rows and null ids
    give rows of their own; an empty table gives no rows; other columns are
    ignored.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(LongestMatch(*word_pieces(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _Counts(automaton.value)
        for batch in batches:
            n_bytes, n_words, n_tokens = [], [], []
            for cell in batch.column(1):
                data = cell.as_py() or b""
                words = tokens = 0
                for part in word_segments(data):
                    found = part.split()
                    words += len(found)
                    tokens += sum(map(lengths.__getitem__, found))
                n_bytes.append(len(data))
                n_words.append(words)
                n_tokens.append(tokens)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_words, n_tokens))],
                ["id", "n_bytes", "n_words", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("data"))
        .mapInArrow(run, f"id {kind}, n_bytes long, n_words long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )
