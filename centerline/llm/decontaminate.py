"""Benchmark passages in documents, found by multi-pattern search over words."""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import batch_of, in_blocks, mapped, texts_of, worker_store
from centerline.session import scratch_dir
from centerline.sources.ranges import open_fs

# Words are runs of ASCII digits and letters and of all bytes from 0x80 on; A-Z become a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(_FOLD).split()


class Words:
    """The words of a text, joined by single spaces, with the places where they begin and end."""

    def __init__(self, words: list[bytes]):
        self.text = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        self.begin = np.concatenate(([0], ends[:-1] + 1)) if len(words) else ends
        self.end = ends

    def __len__(self) -> int:
        return len(self.end)


class Table:
    """Search table for patterns of ``m`` words: the windows of some texts.

    For a block of two words (one, if ``m`` is 1) ``shift`` tells by a hash how far behind it a pattern can end;
    after a block that no pattern holds the search may skip ``m - 1`` words. A block that may end a pattern has 0
    there, and leads by its checksum to a bucket of the different patterns with that end. Each is a stretch of
    ``text`` to compare with, and has the items that hold it. All is kept in arrays: some 40 bytes for each word.
    """

    def __init__(self, m: int, texts: list[tuple[int, list[bytes]]]):
        import xxhash

        self.m, self.block = m, min(2, m)
        block, checksum, digest = self.block, zlib.crc32, xxhash.xxh3_128_intdigest
        bodies, ends, shifts, begin, stop, one, two, items = ([] for _ in range(8))
        base = 0
        for item, words in texts:
            w = Words(words)
            a, z = w.begin.tolist(), w.end.tolist()
            n = len(w)
            sums = np.fromiter((checksum(w.text[a[j]:z[j + block - 1]]) for j in range(n - block + 1)), np.uint32, n - block + 1)
            shifts.append((sums, np.maximum(m - block - np.arange(n - block + 1), 0)))
            ends.append(sums[m - block:])
            both = [digest(w.text[a[s]:z[s + m - 1]]) for s in range(n - m + 1)]
            one.append(np.fromiter((b & 0xFFFFFFFFFFFFFFFF for b in both), np.uint64, len(both)))
            two.append(np.fromiter((b >> 64 for b in both), np.uint64, len(both)))
            begin.append(w.begin[:n - m + 1] + base)
            stop.append(w.end[m - 1:] + base)
            items.append(np.full(n - m + 1, item, dtype=np.int32))
            bodies.append(w.text)
            base += len(w.text)
        self.text = b"".join(bodies)
        size = 1 << max(8, (4 * sum(len(s) for s, _ in shifts)).bit_length())
        self.mask, self.far = size - 1, m - block + 1
        table = np.full(size, self.far, dtype=np.uint8)
        for sums, steps in shifts:
            np.minimum.at(table, sums & np.uint32(self.mask), steps.astype(np.uint8))
        self.shift = table.tobytes()
        ends, one, two, begin, stop, items = (np.concatenate(x) for x in (ends, one, two, begin, stop, items))
        order = np.lexsort((items, two, one, ends))
        ends, one, two, begin, stop, items = (x[order] for x in (ends, one, two, begin, stop, items))
        new = np.ones(len(ends), dtype=bool)  # the first of the windows that are one pattern
        new[1:] = (ends[1:] != ends[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        again = ~new
        again[1:] &= items[1:] == items[:-1]
        at = np.flatnonzero(new)
        self.ends, self.begin, self.stop = ends[at], begin[at], stop[at]
        self.items, self.held = items[~again], np.append(np.cumsum(~again)[at] - 1, int((~again).sum()))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """Start of each occurrence of a pattern, and the items that hold the pattern."""
        m, block, shift, mask, checksum = self.m, self.block, self.shift, self.mask, zlib.crc32
        at, last = m - block, len(words) - block
        while at <= last:
            found = checksum(words[at] if block == 1 else words[at] + b" " + words[at + 1])
            step = shift[found & mask]
            if step:
                at += step
                continue
            start = at + block - m
            key, body = np.uint32(found), None
            for k in range(np.searchsorted(self.ends, key), np.searchsorted(self.ends, key, "right")):
                body = body or b" ".join(words[start:start + m])
                if self.text[self.begin[k]:self.stop[k]] == body:
                    yield start, self.items[self.held[k]:self.held[k + 1]]
                    break
            at += 1


def tables_of(items: list[tuple[int, bytes]], window: int) -> list[Table]:
    """Tables for windows of ``window`` words, by pattern length; an item of fewer words is one pattern."""
    by_length: dict[int, list[tuple[int, list[bytes]]]] = {}
    for item, text in items:
        words = words_of(text)
        if words:
            by_length.setdefault(min(window, len(words)), []).append((item, words))
    return [Table(m, texts) for m, texts in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans put together, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_FOUND = "struct<n_words:long,spans:array<struct<start:int,stop:int>>,items:array<string>>"


def _shares(window: int, size: int):
    """Cut long items to shares of about ``size`` bytes that overlap by a window less one word: no window is lost."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in in_blocks([batch], "text", size):
                names, bodies = [], []
                for name, text in zip(one.column("name").to_pylist(), texts_of(one.column("text"))):
                    if len(text) <= size:
                        names.append(name)
                        bodies.append(text)
                        continue
                    words = Words(words_of(text))
                    first = 0
                    while first < len(words):
                        last = max(int(np.searchsorted(words.end, words.begin[first] + size)), first + window)
                        names.append(name)
                        bodies.append(words.text[words.begin[first]:words.end[min(last, len(words)) - 1]])
                        first = last - window + 1 if last < len(words) else len(words)
                yield batch_of({"name": pa.array(names, pa.string()), "text": pa.array(bodies, pa.binary())})

    return shares


def _tables(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list[str]:
    """Files with the search tables of the benchmark, each for about ``block_bytes`` of its text, built by tasks.

    The names come from tasks that ended well; what a lost task has left is read by nobody. A path for each block
    comes back to the driver.
    """
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    path = scratch_dir(spark, "benchmark-tables")
    cut = mapped(rows, _shares(window, max(block_bytes // 8, 1)), "name string, text binary")
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("text", "name"), F.lit(blocks)))

    def build(share: pa.Table) -> pa.Table:
        names = share.column("name").to_pylist()
        known = sorted({n for n in names if n is not None})
        number = {n: k for k, n in enumerate(known)} | {None: -1}
        tables = tables_of([(number[n], t) for n, t in zip(names, texts_of(share.column("text")))], window)
        filesystem, plain = open_fs(path)
        filesystem.create_dir(plain, recursive=True)
        name = f"block-{share.column('block')[0].as_py()}-{uuid.uuid4().hex}"
        with filesystem.open_output_stream(f"{plain}/{name}") as out:
            pickle.dump((known, [vars(t) for t in tables]), out, protocol=pickle.HIGHEST_PROTOCOL)
        return pa.table({"file": pa.array([f"{path}/{name}"])})

    return [r.file for r in dealt.groupBy("block").applyInArrow(build, "file string").collect()]


def _loaded(file: str) -> tuple[list[str], list[Table]]:
    filesystem, plain = open_fs(file)
    with filesystem.open_input_file(plain) as source:
        names, states = pickle.loads(source.read())
    tables = [Table.__new__(Table) for _ in states]
    for table, state in zip(tables, states):
        table.__dict__.update(state)
    return names, tables


def hits(
    text: Column, benchmark: DataFrame, item_id: str = "item_id", bench_text: str = "text",
    window: int = 13, block_bytes: int = 8 << 20,
) -> Column:
    """A column ``struct(n_words, spans, items)``: which words of a text lie in an occurrence of a benchmark window,
    and which items have an occurring window.

    The benchmark is dealt to blocks of about ``block_bytes`` of text; long items are cut with an overlap. Tasks build
    each block's tables, about six times its text, in a file below the shared folder. A task that searches texts
    holds one block's tables at a time and goes through a batch of texts with each: a larger benchmark costs more
    passes over the batch, and no more memory, and nothing of it goes through the driver but the names of the files.

    A null text has no words, and items with a null text are left out. The windows of items with a null id hit, but
    such items are not among ``items``. An empty benchmark gives empty spans. Items with one id count once.
    """
    return _found(_tables(benchmark, item_id, bench_text, window, block_bytes))(text)


def _found(files: list[str]):
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ])

    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store = worker_store()
        for batch in batches:
            yield searched(batch, store)

    def searched(texts: pa.Array, store: dict) -> pa.Array:
        every = [words_of(t) for t in texts_of(texts)]
        spans: list[list[tuple[int, int]]] = [[] for _ in every]
        items: list[set[str]] = [set() for _ in every]
        for file in files:
            # The last tables read stay with the worker: with one block they are read once.
            if store.get("benchmark file") != file:
                store["benchmark tables"] = None
                store["benchmark tables"] = _loaded(file)
                store["benchmark file"] = file
            names, tables = store["benchmark tables"]
            for i, words in enumerate(every):
                for table in tables:
                    for start, held in table.occurrences(words):
                        spans[i].append((start, start + table.m))
                        items[i].update(names[k] for k in held.tolist() if k >= 0)
        return pa.array([
            {"n_words": len(w), "spans": [{"start": a, "stop": b} for a, b in merged(s)], "items": sorted(x)}
            for w, s, x in zip(every, spans, items)
        ], type=kind)

    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    bench_text: str = "text", window: int = 13, share: int = 20, block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, spans, items, contaminated``.

    A document is contaminated if at least one word in ``share`` is hit. ``spans`` are word positions ``[start,
    stop)``, ``items`` the ids of items with occurring windows, sorted as strings. Nulls as in ``hits``; repeated
    rows are judged each by itself; an empty table gives no rows.
    """
    found = hits(F.col("text"), benchmark, item_id, bench_text, window, block_bytes)
    n_hit = F.aggregate("f.spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]).cast("long"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return (
        rows.select("doc_id", found.alias("f"))
        .select("doc_id", F.col("f.n_words").alias("n_words"), n_hit.alias("n_hit"), "f.spans", "f.items")
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns and unchanged."""
    share = options.pop("share", 20)
    found = hits(F.col(text).cast("string"), benchmark, **options)
    n_hit = F.aggregate(found["spans"], F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]).cast("long"))
    return docs.where(~((n_hit > 0) & (n_hit * share >= found["n_words"])))
