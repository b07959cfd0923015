"""Remove every byte of a long string that an earlier document holds too."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.prefix_free import equal_windows
from citeloom.sources.staged import new_stage_path, write_stage

#: A repeat has at least this many bytes.
SPAN = 50
#: Bytes of a trigger. Every repeat holds SPAN - GRAM + 1 of them, the smallest of which names its phrase.
GRAM = 20
WINDOW = SPAN - GRAM + 1
#: Bytes parsed at a time, and bytes whose phrases are compared before anything is shuffled.
PART, BLOCK = 1 << 19, 8 << 20
#: Phrases that one bucket of the comparison, and one call of the suffix sort, hold about.
BUCKET_PHRASES, CALL_PHRASES = 200_000, 8_000
#: A trigger with more distinct phrases than this in a block is spread over so many groups.
HOT, SPREAD = 64, 64
COVER, ASK, ASK_SPREAD = 0, 1, 2
#: What a packed row holds.
PHRASES, TOLD, KNOWN = b"p", b"t", b"k"
_NO_ID = (1 << 63) - 1
_48 = np.uint64((1 << 48) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def rolling_hash(text: np.ndarray) -> Callable:
    """Hash of ``size`` bytes from ``at``, for arrays of both."""
    prefix = np.zeros(len(text) + 1, np.uint64)
    if len(text):
        prefix[1:] = np.cumsum(_BYTES[text] * _powers(_ODD, len(text)))
    undo = _powers(_INVERSE, len(text) + 1)
    return lambda at, size: (prefix[at + size] - prefix[at]) * undo[at]


class Parse:
    """Phrases of one stretch of bytes; ``ends`` holds for each byte where its document ends.

    A rolling hash runs over all strings of ``GRAM`` bytes. The trigger of a
    window of ``SPAN`` bytes is its smallest hash, leftmost first, and a phrase
    is a maximal run of windows with one trigger, with all bytes these windows
    touch. So equal windows of any two documents lie in phrases of equal trigger.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray) -> None:
        n = len(text)
        self.text = text
        self._hash = rolling_hash(text)
        here = np.flatnonzero(ends - np.arange(n) >= SPAN)
        if not len(here):
            self.first = self.windows = self.trigger = self.content = np.zeros(0, np.int64)
            return
        grams = _mix(self._hash(np.arange(n - GRAM + 1), GRAM))
        least, place = grams, np.arange(len(grams), dtype=np.int32)
        size = 1
        while size < WINDOW:
            step = min(size, WINDOW - size)
            m = len(least) - step
            right = least[step:] < least[:m]
            place = np.where(right, place[step:], place[:m])
            least = np.where(right, least[step:], least[:m])
            size += step
        at = place[here]
        new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (here[1:] != here[:-1] + 1))))
        self.first = here[new]
        self.windows = np.diff(np.append(new, len(here)))
        self.trigger = grams[at[new]] >> np.uint64(16)
        self.content = (
            _mix(self._hash(self.first, self.windows + SPAN - 1) + self.windows.astype(np.uint64)) & _48
        )

    def window_groups(self, at: np.ndarray, groups: int) -> np.ndarray:
        return (_mix(self._hash(at, SPAN)) % np.uint64(groups)).astype(np.int64)


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, bytes, end of the own document, first byte of each) of about PART bytes.

    A longer document is parsed in overlapping parts, cut so that each window
    lies in one of them; phrases may be cut there, which changes no window.
    """
    held, size = [], 0
    for k, text in enumerate(texts):
        if len(text) < SPAN:
            continue
        if len(text) > 2 * PART:
            for at in range(0, len(text) - SPAN + 1, PART):
                part = text[at : at + PART + SPAN - 1]
                yield [(k, at)], np.frombuffer(part, np.uint8), np.full(len(part), len(part))
            continue
        held.append(k)
        size += len(text)
        if size >= PART:
            yield _joined(texts, held)
            held, size = [], 0
    if held:
        yield _joined(texts, held)


def _joined(texts: list[bytes], held: list[int]):
    lengths = np.array([len(texts[k]) for k in held])
    ends = np.cumsum(lengths)
    return [(k, 0) for k in held], np.frombuffer(b"".join(texts[k] for k in held), np.uint8), np.repeat(ends, lengths)


def parsed(texts: list[bytes]) -> Iterator[tuple[Parse, np.ndarray, np.ndarray]]:
    """Each parse with, per phrase, its text's number and its first window's place there."""
    for held, text, ends in _parts(texts):
        parse = Parse(text, ends)
        starts = np.unique(np.concatenate(([0], ends[:-1][np.diff(ends) != 0]))) if len(held) > 1 else np.zeros(1, np.int64)
        which = np.searchsorted(starts, parse.first, side="right") - 1
        numbers = np.array([k for k, _ in held])
        shifts = np.array([at for _, at in held])
        yield parse, numbers[which], parse.first - starts[which] + shifts[which]


# Phrases of a block of documents


def _pack(trigger: np.ndarray, content: np.ndarray, ids: np.ndarray, hot: np.ndarray) -> bytes:
    """Sorted columns, byte planes apart, compressed."""
    order = np.argsort(trigger, kind="stable")
    trigger, content, ids, hot = trigger[order], content[order], ids[order], hot[order]
    steps = np.diff(trigger, prepend=np.uint64(0))
    known, place = np.unique(ids, return_inverse=True)
    planes = [
        np.uint64([len(trigger), len(known)]).tobytes(),
        known.astype(np.int64).tobytes(),
        steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes(),
        content.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes(),
        place.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(),
        hot.astype(np.uint8).tobytes(),
    ]
    raw = b"".join(planes)
    return b"r" + raw if len(trigger) < 32 else b"z" + zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = blob[1:] if blob[:1] == b"r" else zstandard.ZstdDecompressor().decompress(blob[1:])
    n, m = np.frombuffer(raw, np.uint64, 2).astype(int).tolist()
    known = np.frombuffer(raw, np.int64, m, 16)
    at = 16 + 8 * m

    def column(width: int, kind: str) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize
        out = np.zeros((n, size), np.uint8)
        out[:, :width] = np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n).T
        at += width * n
        return out.view(kind).reshape(n)

    trigger = np.cumsum(column(6, "<u8"))
    content = column(6, "<u8")
    ids = known[column(4, "<u4")]
    return trigger, content, ids, np.frombuffer(raw, np.uint8, n, at).astype(bool)


def _block_rows(ids: list[int], texts: list[bytes], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packed columns): phrases to compare, spread triggers, and items already known.

    A block sends each phrase once, for its smallest id; its other documents
    that hold the phrase are covered whatever other blocks hold.
    """
    numbers = np.array(ids, np.int64)
    found = [(p.trigger, p.content, numbers[k]) for p, k, _ in parsed(texts)]
    if not found:
        return
    trigger, content, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((owner, content, trigger))
    trigger, content, owner = trigger[order], content[order], owner[order]
    fresh = np.concatenate(([True], (trigger[1:] != trigger[:-1]) | (content[1:] != content[:-1])))
    distinct = fresh | np.concatenate(([True], owner[1:] != owner[:-1]))
    least = owner[fresh][np.cumsum(fresh) - 1]
    known = np.flatnonzero(distinct & ~fresh & (owner > least))
    for k in range(0, len(known), BUCKET_PHRASES // 32):
        some = known[k : k + BUCKET_PHRASES // 32]
        items = np.concatenate((owner[some], (content[some] << np.uint64(2)).astype(np.int64) | COVER))
        # Any bucket may pass these on.
        yield int(_mix(trigger[some[:1]])[0] % np.uint64(buckets)), KNOWN + zstandard.ZstdCompressor(level=1).compress(items.tobytes())
    trigger, content, owner = trigger[fresh], content[fresh], owner[fresh]
    _, group, members = np.unique(trigger, return_inverse=True, return_counts=True)
    hot = members[group] > HOT
    # Triggers are minima and lie close to zero, so they are mixed first.
    own = _mix(trigger) % np.uint64(buckets)
    bucket = np.where(hot, _mix(trigger ^ (content << np.uint64(16))) % np.uint64(buckets), own).astype(np.int64)
    # A spread trigger still tells its own bucket that it is one.
    told = np.flatnonzero(hot & np.concatenate(([True], trigger[1:] != trigger[:-1])))
    for sort, rows in ((PHRASES, np.arange(len(trigger))), (TOLD, told)):
        at = own[rows].astype(np.int64) if sort == TOLD else bucket
        order = np.argsort(at, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
            if len(part):
                take = rows[part]
                yield int(at[part[0]]), sort + (
                    trigger[take].astype("<u8").tobytes()
                    if sort == TOLD
                    else _pack(trigger[take], content[take], owner[take], hot[take])
                )


def _parse_task(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for bucket, packed in _block_rows(ids, texts, buckets):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int32()), pa.array([packed], pa.binary())], ["bucket", "packed"]
                )

        for batch in batches:
            for i, cell in zip(*batch.columns, strict=True):
                ids.append(i.as_py())
                texts.append(cell.as_py() or b"")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield from flush()
                    ids, texts, size = [], [], 0
        yield from flush()

    return run


def _compare_bucket(bucket: pa.Table) -> pa.Table:
    """Items of the documents of one bucket: phrases that are covered, and phrases whose bytes are asked for."""
    packed = [c.as_py() for c in bucket["packed"]]
    told = [np.frombuffer(b, "<u8", offset=1) for b in packed if b[:1] == TOLD]
    columns = [_unpack(b[1:]) for b in packed if b[:1] == PHRASES]
    known = [
        np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.int64).reshape(2, -1)
        for b in packed
        if b[:1] == KNOWN
    ]
    ids, items = np.concatenate(known, axis=1) if known else np.zeros((2, 0), np.int64)
    if not columns:
        return pa.table({"id": ids, "item": items})
    trigger, content, owner, hot = (np.concatenate(x) for x in zip(*columns, strict=True))
    order = np.lexsort((owner, content, trigger))
    trigger, content, owner, hot = trigger[order], content[order], owner[order], hot[order]
    new = np.concatenate(([True], trigger[1:] != trigger[:-1]))
    fresh = new | np.concatenate(([True], content[1:] != content[:-1]))
    group, phrase = np.cumsum(new) - 1, np.cumsum(fresh) - 1
    least = owner[fresh][phrase]
    phrases = np.bincount(group[fresh])[group]
    spread = hot | np.isin(trigger, np.concatenate(told)) if told else hot
    # One spread row makes its trigger a spread one, in this bucket or by what it was told.
    asked = (owner == least) & fresh & ((phrases > 1) | spread)
    covered = owner > least
    kind = np.where(covered, COVER, np.where(spread, ASK_SPREAD, ASK)).astype(np.uint64)
    item = (content << np.uint64(2) | kind).astype(np.int64)
    keep = asked | covered
    return pa.table(
        {"id": np.concatenate((ids, owner[keep])), "item": np.concatenate((items, item[keep]))}
    )


# Phrases whose bytes have to be compared


def _keys(rows: np.ndarray, contents: np.ndarray) -> np.ndarray:
    """Phrase names told apart by the row of a batch that they belong to."""
    return rows.astype(np.uint64) << np.uint64(48) | contents.astype(np.uint64)


def _asked_rows(ids: list[int], texts: list[bytes], asked: list[np.ndarray]) -> Iterator[tuple]:
    """(group, id, content, windows to compare, bytes) of the phrases asked of each text."""
    items = np.concatenate([np.zeros(0, np.int64), *asked])
    rows = np.repeat(np.arange(len(asked)), [len(a) for a in asked])
    wanted = _keys(rows, items >> 2)
    order = np.argsort(wanted)
    wanted, kinds = wanted[order], (items & 3)[order]
    done: set[int] = set()
    for parse, which, _ in parsed(texts):
        keys = _keys(which, parse.content)
        for k in np.flatnonzero(np.isin(keys, wanted)):
            key = int(keys[k])
            if key in done:
                continue
            done.add(key)
            own_id, name = ids[which[k]], int(parse.content[k])
            first, windows = int(parse.first[k]), int(parse.windows[k])
            data = parse.text[first : first + windows + SPAN - 1].tobytes()
            trigger = int(parse.trigger[k])
            if kinds[np.searchsorted(wanted, keys[k])] == ASK:
                yield trigger, own_id, name, (1 << windows) - 1, data
                continue
            groups = parse.window_groups(np.arange(first, first + windows), SPREAD)
            for g in np.unique(groups):
                mask = sum(1 << int(o) for o in np.flatnonzero(groups == g))
                yield trigger ^ (int(g) + 1) << 48, own_id, name, mask, data


_ASKED = pa.schema(
    [("key", pa.int64()), ("id", pa.int64()), ("content", pa.int64()), ("mask", pa.int64()), ("data", pa.binary())]
)


def _text_batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of few rows and, but for single long texts, few bytes."""
    for batch in batches:
        sizes = np.array(pc.fill_null(pc.binary_length(batch.column(text)), 0))
        at = 0
        while at < batch.num_rows:
            to = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + 4096]), 4 * PART)))
            yield batch.slice(at, to - at)
            at = to


def _ask_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _text_batches(batches, 1):
        ids, texts, asked = [], [], []
        for i, text, items in zip(*batch.columns, strict=True):
            if items.is_valid and text.is_valid and len(items):
                ids.append(i.as_py())
                texts.append(text.as_py())
                asked.append(items.values.to_numpy())
        rows = list(_asked_rows(ids, texts, asked)) if ids else []
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, _ASKED.types, strict=True)], schema=_ASKED
            )


def _sort_call(call: pa.Table) -> pa.Table:
    """Which windows of each phrase an earlier document holds, from the suffix order of the phrases.

    Phrases without any window whose hash occurs twice need not be sorted.
    """
    ids, content = call["id"].to_numpy(), call["content"].to_numpy()
    masks = call["mask"].to_numpy()
    data = [c.as_py() for c in call["data"]]

    def laid_out(rows: np.ndarray):
        lengths = np.array([len(data[r]) for r in rows], np.int64)
        ends = np.repeat(np.cumsum(lengths), lengths)
        row = np.repeat(rows, lengths)
        text = np.frombuffer(b"".join(data[r] for r in rows), np.uint8)
        offset = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        wanted = ((masks[row] >> np.minimum(offset, 62)) & 1 == 1) & (ends - np.arange(len(text)) >= SPAN)
        return text, ends, row, offset, wanted

    text, _, row, _, wanted = laid_out(np.arange(len(data)))
    at = np.flatnonzero(wanted)
    hashes = _mix(rolling_hash(text)(at, SPAN))
    order = np.argsort(hashes)
    same = np.concatenate((hashes[order[1:]] == hashes[order[:-1]], [False])) if len(at) else np.zeros(0, bool)
    repeated = np.concatenate((order[same], order[1:][same[:-1]])) if len(at) else order
    text, ends, row, offset, wanted = laid_out(np.unique(row[at[repeated]]))
    order, fresh = equal_windows(text, ends, wanted, SPAN)
    marked = np.zeros(len(data), np.int64)
    if len(order):
        least = np.minimum.reduceat(ids[row[order]], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
        late = order[least < ids[row[order]]]
        np.bitwise_or.at(marked, row[late], np.int64(1) << offset[late])
    hit = np.flatnonzero(marked)
    return pa.table({"id": ids[hit], "content": content[hit], "mask": marked[hit]})


# Cutting


def repeated_bytes(texts: list[bytes], covered: np.ndarray, marked: np.ndarray, masks: np.ndarray) -> list[np.ndarray]:
    """Per text, True for each byte of a window that an earlier document holds.

    ``covered`` and ``marked`` are phrase keys by row of ``texts``; a marked
    phrase has a mask of its windows.
    """
    gone = [np.zeros(len(t), bool) for t in texts]
    order = np.argsort(marked)
    marked, masks = marked[order], masks[order]
    for parse, which, places in parsed(texts):
        keys = _keys(which, parse.content)
        edge = np.zeros(len(parse.text) + 1, np.int32)
        whole = np.flatnonzero(np.isin(keys, covered))
        np.add.at(edge, parse.first[whole], 1)
        np.add.at(edge, parse.first[whole] + parse.windows[whole] + SPAN - 1, -1)
        if len(marked):
            some = np.flatnonzero(np.isin(keys, marked))
            mask, first = masks[np.searchsorted(marked, keys[some])], parse.first[some]
            for o in range(int(parse.windows[some].max(initial=0))):
                hit = first[(mask >> o) & 1 == 1] + o
                np.add.at(edge, hit, 1)
                np.add.at(edge, hit + SPAN, -1)
        cut = np.cumsum(edge[:-1]) > 0
        rows, at = np.unique(which, return_index=True)
        # A text's first phrase begins where the text, or the part of it, does.
        for k, begin, place in zip(rows.tolist(), parse.first[at].tolist(), places[at].tolist(), strict=True):
            size = min(len(texts[k]) - place, len(cut) - begin)
            gone[k][place : place + size] |= cut[begin : begin + size]
    return gone


def whole_characters(data: bytes, gone: np.ndarray) -> bytes:
    """The kept bytes without those of characters of which a byte is gone."""
    raw = np.frombuffer(data, np.uint8)
    first = (raw & 0xC0) != 0x80
    first[0] = True
    character = np.cumsum(first) - 1
    broken = np.zeros(character[-1] + 1, bool)
    broken[character[gone]] = True
    return raw[~broken[character]].tobytes()


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of all list members."""
    sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _cut_task(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _text_batches(batches, width):
            texts = [c.as_py() or b"" for c in batch.column(width)]
            row, item = _flat(batch.column(width + 1))
            covered = _keys(row, item >> 2)[item & 3 == COVER]
            row, name = _flat(batch.column(width + 2))
            marked, position = np.unique(_keys(row, name), return_inverse=True)
            masks = np.zeros(len(marked), np.int64)
            np.bitwise_or.at(masks, position.reshape(-1), _flat(batch.column(width + 3))[1])
            gone = repeated_bytes(texts, covered, marked, masks)
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "kept_sha256": []}
            for data, cut in zip(texts, gone, strict=True):
                removed = int(cut.sum())
                left = np.frombuffer(data, np.uint8)[~cut].tobytes() if removed else data
                out["n_bytes"].append(len(data))
                out["n_removed"].append(removed)
                out["n_spans"].append(int(cut[:1].sum()) + int((cut[1:] & ~cut[:-1]).sum()))
                out["kept"].append(whole_characters(data, cut) if removed else data)
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:width],
                    *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                    pa.array(out["kept"], pa.binary()),
                    pa.array(out["kept_sha256"]),
                ],
                names=[*(f"c{k}" for k in range(width)), *out],
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """Cut every byte covered by a ``SPAN``-byte string that also starts in a document of smaller id.

    1. Each block of documents is parsed into phrases at rolling-hash triggers;
       only digests of distinct phrases leave the task.
    2. Per trigger, phrases that an earlier document holds whole are covered.
       Triggers with several phrases ask for the bytes of each phrase's first
       holder; these phrases are all that has to be sorted.
    3. Their suffix order comes from prefix-free parsing: windows that are equal
       are neighbours in it, and the smallest id among them decides.
    4. The marks go back to the texts by id and the bytes are cut.

    Result: id, the given ``columns``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept`` (remaining bytes, less those of characters
    cut in two) and ``kept_sha256`` (of all remaining bytes). Strings are judged
    on the input. A null text counts as empty; a null id comes after all others;
    rows of one id are one document as to what is earlier, and are cut alike;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"),
        F.col(id_col).alias("c0"),
        *(F.col(f"`{c}`").alias(f"c{k + 1}") for k, c in enumerate(columns)),
        F.col(text_col).cast("binary").alias("text"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size * 2 / (WINDOW + 1) / BUCKET_PHRASES))
    items = (
        rows.select("key", "text")
        .mapInArrow(_parse_task(buckets), "bucket int, packed binary")
        .groupBy("bucket")
        .applyInArrow(_compare_bucket, "id long, item long")
    )
    known = write_stage(
        items.groupBy(F.col("id").alias("known")).agg(F.collect_list("item").alias("items")),
        new_stage_path(spark, "items"),
    )
    asked = F.filter("items", lambda x: x.bitwiseAND(3) != COVER)
    asks = known.agg(F.coalesce(F.sum(F.size(asked)), F.lit(0))).first()[0]
    calls = max(1, math.ceil(asks / CALL_PHRASES))
    given = rows.select("key", "text").join(known, F.col("key") == F.col("known"), "left")
    wanted = given.select("key", "text", F.when(F.size(asked) > 0, asked).alias("asked")).mapInArrow(
        _ask_task, "key long, id long, content long, mask long, data binary"
    )
    marks = (
        wanted.groupBy(F.pmod(F.xxhash64("key"), F.lit(calls)).alias("call"))
        .applyInArrow(_sort_call, "id long, content long, mask long")
        .groupBy(F.col("id").alias("marked"))
        .agg(F.collect_list("content").alias("contents"), F.collect_list("mask").alias("masks"))
    )
    width = 1 + len(columns)
    kinds = [docs.schema[c].dataType.simpleString() for c in (id_col, *columns)]
    names = [f"c{k}" for k in range(width)]
    return (
        rows.join(known, F.col("key") == F.col("known"), "left")
        .join(marks, F.col("key") == F.col("marked"), "left")
        .select(*names, "text", "items", "contents", "masks")
        .mapInArrow(
            _cut_task(width),
            ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
            + ", n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
        )
        .toDF(id_col, *columns, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256")
    )
