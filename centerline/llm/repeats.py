"""Passages of at least so many words that also stand earlier in the corpus: the part that operators share.

A window is ``window`` consecutive words of one document. A window is repeated if the same words also start earlier:
in a document with a smaller id, or in the same document before. The words of repeated windows are the result; which
is exact, and does not depend on how a caller chooses its anchors.

An anchor is a position that a window's words alone select, so equal windows have their anchors at equal places.
Neighbouring windows mostly select the same position; what they cover together is a segment, and one row stands for
all of them:

1. Each task gives one row per segment. Rows meet by the words at their anchor, in sorted order. Of equal segments
   all but the earliest are repeated as a whole. Segments whose anchor occurs in no other segment are done.
2. For the rest (the earliest of their kind, at the edges of repeats) the single windows are compared, in sorted order.
3. Repeated words are put together for each document.

A crowded segment costs one row for each block of documents that a task reads, since equal ones are put together
before they are sent, and sorted rows are compared one after the other, so no group is ever held in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import WordHashes, batch_of, in_blocks, mix, texts_of, written

U = np.uint64
# Bits of a sort key that hold a position within a block, as many as a text can have words; the others hold the order
# of the anchor there.
_AT = 31
_AT_MASK = U((1 << _AT) - 1)
# Odd bases of the rolling hashes, and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
NO_ID = (1 << 63) - 1

# Given two hashes per word and the number of words behind each position in its document: for each position the order
# of an anchor there (smaller is better) and a hash of the words that it stands for.
Anchors = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Rolling:
    """Hashes of spans of words from prefix sums of ``hash * base ** position``."""

    def __init__(self, hashes: np.ndarray, which: int):
        n = len(hashes)
        self.inverse = _powers(_INVERSES[which], n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(_BASES[which], n), dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.inverse[start])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    out[1:] = U(base)
    return np.cumprod(out, dtype=np.uint64)[:n]


def least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` neighbouring keys, from each position on."""
    have, span = keys, 1
    while span * 2 <= width:
        have = np.minimum(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return np.minimum(have[:-rest], have[rest:]) if rest else have


class Block:
    """The words of some documents, one after the other."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes):
        words = [t.split() if t else [] for t in texts]
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self.first, self.second = hashes.of([w for doc in words for w in doc])
        self.document = np.repeat(np.arange(len(words)), self.sizes)
        self.behind = self.offsets[1:][self.document] - np.arange(len(self.first))


def segments(block: Block, window: int, reach: int, anchors: Anchors) -> tuple[np.ndarray, ...] | None:
    """Document, first start, number of starts, anchor hash and content hash of each segment of a block."""
    n = len(block.first)
    width = window - reach + 1
    if n < window or not (block.behind >= window).any():
        return None
    order, seeds = anchors(block.first, block.second, block.behind)
    keys = (order & ~_AT_MASK) | np.arange(n, dtype=np.uint64)
    chosen = (least_of(keys, width) & _AT_MASK).astype(np.int64)
    starts = np.flatnonzero(block.behind[: len(chosen)] >= window)
    at = chosen[starts]
    new = np.concatenate(([True], (starts[1:] != starts[:-1] + 1) | (at[1:] != at[:-1])))
    first = starts[new]
    last = starts[np.concatenate((np.flatnonzero(new)[1:], [len(starts)])) - 1]
    content = Rolling(block.first, 0).of(first, last + window) ^ mix(last - first)
    document = block.document[first]
    return document, first - block.offsets[document], last - first + 1, seeds[at[new]], content


_ROW = "seed long, content long, doc_id long, mark int, start int, n int"
_SPAN = "kind int, doc_id long, mark int, start int, stop int"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _segment_rows(window: int, reach: int, anchors: Anchors):
    """Rows of segments; ``n`` is below 0 in a row that is a repeated span of ``-n`` words already."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_blocks(batches, "text", 4 << 20):
            found = segments(Block(texts_of(batch.column("text")), hashes), window, reach, anchors)
            if found is None:
                continue
            document, start, n, seed, content = found
            doc_id = batch.column("doc_id").to_numpy(zero_copy_only=False)[document]
            mark = batch.column("mark").to_numpy(zero_copy_only=False)[document]
            later = _later(content, doc_id, start)
            keep = ~later
            out = [(seed[keep], content[keep], doc_id[keep], mark[keep], start[keep], n[keep])]
            if later.any():
                d, a, b = _joined(document[later], start[later], start[later] + n[later] - 1 + window)
                ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[d]
                marks = batch.column("mark").to_numpy(zero_copy_only=False)[d]
                spread = mix(mix(ids.astype(np.int64).view(np.uint64)) + a.astype(np.uint64))
                out.append((spread, spread, ids, marks, a, a - b))
            seed, content, doc_id, mark, start, n = (np.concatenate(x) for x in zip(*out))
            yield batch_of({
                "seed": _signed(seed), "content": _signed(content), "doc_id": doc_id.astype(np.int64),
                "mark": mark.astype(np.int32), "start": start.astype(np.int32), "n": n.astype(np.int32),
            })

    return rows


def _later(content: np.ndarray, doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows have an equal content that starts earlier."""
    by = np.lexsort((start, doc_id, content))
    c, d, s = content[by], doc_id[by], start[by]
    head = np.concatenate(([True], c[1:] != c[:-1]))
    first = np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))
    out = np.empty(len(by), dtype=bool)
    out[by] = (d != d[first]) | (s != s[first])
    return out


def _joined(document: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of a document put together."""
    by = np.lexsort((start, document))
    document, start, stop = document[by], start[by], stop[by]
    far = int(stop.max()) + 1
    reached = np.maximum.accumulate(stop + document * far)
    head = np.concatenate(([True], start[1:] + document[1:] * far > reached[:-1]))
    tail = np.concatenate((np.flatnonzero(head)[1:], [len(by)])) - 1
    return document[head], start[head], (reached - document * far)[tail]


def _span_batch(rows: list[tuple[int, int, int, int, int]]) -> pa.RecordBatch:
    kind, doc_id, mark, start, stop = zip(*rows) if rows else ((),) * 5
    return batch_of({
        "kind": pa.array(kind, pa.int32()), "doc_id": pa.array(doc_id, pa.int64()), "mark": pa.array(mark, pa.int32()),
        "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32()),
    })


def _neighbours(window: int):
    """Compare sorted segments with their neighbours.

    Gives spans that are repeated (kind 0), and ranges of starts whose windows must be compared (kind 1): of the
    earliest segment of each content, where another content has the same anchor.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("seed", "content", "doc_id", "mark", "start", "n")
        held = None
        seed = content = earliest = None
        waiting: list[tuple] = []
        alone = True

        def run(columns: list[np.ndarray], stop: int) -> list[tuple]:
            """Rows up to ``stop``; the one at ``stop`` is only looked at."""
            nonlocal seed, content, earliest, waiting, alone
            out: list[tuple] = []
            seeds, ns = columns[0], columns[5]
            size = len(seeds)
            near = np.zeros(size, dtype=bool)
            near[1:] = seeds[1:] == seeds[:-1]
            near[:-1] |= seeds[1:] == seeds[:-1]
            near[0] |= seed is not None and seed == int(seeds[0])
            done = ns < 0
            for i in np.flatnonzero(done[:stop]).tolist():
                out.append((0, int(columns[2][i]), int(columns[3][i]), int(columns[4][i]), int(columns[4][i] - ns[i])))
            pick = np.flatnonzero(near[:stop] & ~done[:stop])
            for s, c, d, m, a, n in zip(*(x[pick].tolist() for x in columns)):
                if s != seed:
                    seed, content, earliest, waiting, alone = s, c, (d, a), [(1, d, m, a, a + n)], True
                elif c != content:
                    content, earliest, alone = c, (d, a), False
                    out += [*waiting, (1, d, m, a, a + n)]
                    waiting = []
                elif (d, a) != earliest:
                    out.append((0, d, m, a, a + n - 1 + window))
                elif alone:
                    waiting.append((1, d, m, a, a + n))
                else:
                    out.append((1, d, m, a, a + n))
            return out

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in names]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns)]
            last = len(columns[0]) - 1
            yield _span_batch(run(columns, last))
            held = [x[last:] for x in columns]
        if held is not None:
            yield _span_batch(run(held, 1))

    return compare


_WINDOW = "w1 long, w2 long, doc_id long, mark int, start int"


def _window_rows(window: int):
    """The windows that start in given ranges, by two hashes of their words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in in_blocks(batches, "text", 4 << 20):
            block = Block(texts_of(batch.column("text")), hashes)
            ranges = batch.column("ranges").to_pylist()
            at, document = [], []
            for i, own in enumerate(ranges):
                for r in own:
                    starts = np.arange(r["start"], r["stop"], dtype=np.int64)
                    at.append(starts)
                    document.append(np.full(len(starts), i))
            if not at:
                continue
            start, document = np.concatenate(at), np.concatenate(document)
            here = start + block.offsets[document]
            first, second = Rolling(block.first, 0), Rolling(block.second, 1)
            yield batch_of({
                "w1": _signed(first.of(here, here + window)), "w2": _signed(second.of(here, here + window)),
                "doc_id": batch.column("doc_id").to_numpy(zero_copy_only=False)[document].astype(np.int64),
                "mark": batch.column("mark").to_numpy(zero_copy_only=False)[document].astype(np.int32),
                "start": start.astype(np.int32),
            })

    return rows


def _repeated_windows(window: int):
    """Compare sorted windows with the one before: all but the earliest of equal ones are repeated."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # hashes, id and start of the earliest window of the last group
        for batch in batches:
            if not batch.num_rows:
                continue
            w1, w2, doc_id, mark, start = (
                batch.column(x).to_numpy(zero_copy_only=False) for x in ("w1", "w2", "doc_id", "mark", "start")
            )
            head = np.concatenate(([True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])))
            if before is not None and (w1[0], w2[0]) == before[:2]:
                head[0] = False
            first = np.maximum.accumulate(np.where(head, np.arange(len(w1)), -1))
            d, s = doc_id[first], start[first]
            if before is not None:
                d, s = np.where(first < 0, before[2], d), np.where(first < 0, before[3], s)
            repeated = (doc_id != d) | (start != s)
            before = (w1[-1], w2[-1], d[-1], s[-1])
            stop = start + window
            yield batch_of({
                "kind": np.zeros(int(repeated.sum()), dtype=np.int32), "doc_id": doc_id[repeated],
                "mark": mark[repeated], "start": start[repeated], "stop": stop[repeated].astype(np.int32),
            })

    return compare


def keyed(docs: DataFrame, doc_id: str, text: str, others: list[Column] | None = None) -> DataFrame:
    """Documents with an id that is never null and a mark that tells texts of one id apart."""
    body = F.col(text).cast("string")
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.xxhash64(body).bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(0)).cast("int").alias("mark"),
        body.alias("text"), *(others or []),
    )


def repeated_spans(docs: DataFrame, window: int, reach: int, anchors: Anchors) -> DataFrame:
    """``doc_id, mark, start, stop`` of repeated words, as spans that may overlap.

    ``docs`` comes from ``keyed``. ``reach`` is how many words from a position on decide its anchor; windows choose
    among the ``window - reach + 1`` positions whose anchors they decide.
    """
    rows = docs.select("doc_id", "mark", "text").mapInArrow(_segment_rows(window, reach, anchors), _ROW)
    compared = rows.repartition("seed").sortWithinPartitions("seed", "content", "doc_id", "start")
    found = written(compared.mapInArrow(_neighbours(window), _SPAN), "segments")
    ranges = found.where("kind = 1").groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    open_windows = docs.select("doc_id", "mark", "text").join(ranges, ["doc_id", "mark"]).mapInArrow(_window_rows(window), _WINDOW)
    single = (
        open_windows.repartition("w1", "w2").sortWithinPartitions("w1", "w2", "doc_id", "start")
        .mapInArrow(_repeated_windows(window), _SPAN)
    )
    return found.where("kind = 0").unionAll(single).select("doc_id", "mark", "start", "stop")


_WORD = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
_CUT = (
    "n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept_sha256 string, text string"
)


def cut(text: bytes | None, spans: list[tuple[int, int]]) -> tuple[int, int, list[tuple[int, int]], str, bytes | None]:
    """Number of words, number removed, spans put together, digest of the kept words, and the text without the spans.

    The text keeps its white space: a span is cut from its first word up to the next word that stays.
    """
    words = text.split() if text else []
    if not spans:
        return len(words), 0, [], hashlib.sha256(b" ".join(words)).hexdigest(), text
    joined: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(stop, joined[-1][1]))
        else:
            joined.append((start, stop))
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    kept, parts, at, place = [], [], 0, 0
    for start, stop in joined:
        kept += words[at:start]
        parts.append(text[place:places[start]])
        at, place = stop, places[stop]
    kept += words[at:]
    parts.append(text[place:])
    return len(words), len(words) - len(kept), joined, hashlib.sha256(b" ".join(kept)).hexdigest(), b"".join(parts)


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in in_blocks(batches, "text", 16 << 20):
        found = [
            cut(t, [(s["start"], s["stop"]) for s in spans or ()])
            for t, spans in zip(texts_of(batch.column("text")), batch.column("found").to_pylist())
        ]
        n_words, n_removed, spans, digest, text = zip(*found) if found else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] not in ("text", "found")] + [
                pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in own] for own in spans], spans_type),
                pa.array(digest, pa.string()), pa.array(text, pa.binary()).cast(pa.string()),
            ],
            [x for x in batch.schema.names if x not in ("text", "found")]
            + ["n_words", "n_removed", "spans", "kept_sha256", "text"],
        )


def without_repeats(docs: DataFrame, window: int, reach: int, anchors: Anchors) -> DataFrame:
    """``docs`` from ``keyed`` (other columns stay) with ``n_words, n_removed, spans, kept_sha256`` and the cut ``text``."""
    spans = repeated_spans(docs, window, reach, anchors)
    own = spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("found"))
    both = docs.join(own, ["doc_id", "mark"], "left")
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return both.mapInArrow(_cutter, f"{rest}, {_CUT}")
