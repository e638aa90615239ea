"""Token counts without moving a pre-token between tasks."""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import batch_of, in_blocks, mapped, worker_store

# Fixed value: the pre-token pattern of the vocabulary file, in the syntax of the ``regex`` module.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Ranges outside which Unicode versions class a code point differently, so that two libraries may cut a
# text differently. A text with such a character is left to the tokenizer library as a whole.
SETTLED = (
    (0x0, 0x557), (0x590, 0x870), (0x900, 0xC5B), (0xD00, 0x208E), (0x20A0, 0xA7CD), (0xA800, 0xAB6B),
    (0xAB70, 0xD7FF), (0xE000, 0x107BA), (0x1F000, 0x1FAFF),
)


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable characters of Latin-1 stand for themselves, the other bytes in order for those from 256 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def load(path: str):
    """The tokenizer and its special strings, longest first."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, sorted(special, key=len, reverse=True)


def shared(path: str):
    """``load``, once for each Python worker."""
    store = worker_store()
    if f"tokenizer {path}" not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        store[f"tokenizer {path}"] = load(path)
    return store[f"tokenizer {path}"]


def splitter(special: list[str]):
    """A function that cuts a text into pre-tokens and counts the special strings in it.

    A special string is one token wherever it stands, so the text between two of them is cut by itself.
    """
    import regex

    find = regex.compile(PRE_TOKEN).findall
    marks = re.compile("|".join(map(re.escape, special))) if special else None

    def split(text: str) -> tuple[list[str], int]:
        if marks is None or not any(s in text for s in special):
            return find(text), 0
        parts = marks.split(text)
        return [p for part in parts for p in find(part)], len(parts) - 1

    return split


def _trimmed(counts: dict[str, int], size: int) -> dict[str, int]:
    """The ``size`` largest counts, each less the largest that went: what is left bounds a count from below."""
    if len(counts) <= size:
        return counts
    ranked = Counter(counts).most_common(size + 1)
    off = ranked[-1][1]
    return {w: n - off for w, n in ranked[:-1] if n > off}


_SUMMARY = "grp long, words array<string>, counts array<long>"


def frequent_pre_tokens(docs: DataFrame, path: str, text: str = "text", size: int = 8192, fan_in: int = 64) -> list[str]:
    """The most frequent pre-tokens of all texts, at most ``size``.

    Each task keeps a summary of at most ``8 * size`` counts while it reads, and gives one row. Rows are then put
    together ``fan_in`` at a time until one is left, so no task ever holds more than ``fan_in`` summaries, and what
    moves is one summary per task. No pre-token is a shuffle key.
    """

    _, special = load(path)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        split = splitter(special)
        counts: Counter = Counter()
        for batch in batches:
            for block in in_blocks([batch], "text", 1 << 20):
                for value in block.column(0).to_pylist():
                    if value:
                        counts.update(split(value)[0])
                if len(counts) > 16 * size:
                    counts = Counter(_trimmed(counts, 8 * size))
        top = _trimmed(counts, size)
        yield batch_of({
            "grp": pa.array([TaskContext.get().partitionId()], pa.int64()),
            "words": pa.array([list(top)], pa.list_(pa.string())),
            "counts": pa.array([list(top.values())], pa.list_(pa.int64())),
        })

    def together(rows: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for words, counts in zip(rows.column("words").to_pylist(), rows.column("counts").to_pylist()):
            total.update(dict(zip(words, counts)))
        top = _trimmed(total, size)
        return pa.table({
            "grp": pa.array([rows.column("grp")[0].as_py()], pa.int64()),
            "words": pa.array([list(top)], pa.list_(pa.string())),
            "counts": pa.array([list(top.values())], pa.list_(pa.int64())),
        })

    source = docs.select(F.col(text).cast("string").alias("text"))
    rows = mapped(source, summaries, _SUMMARY)
    left = source.rdd.getNumPartitions()
    while True:
        left = -(-left // fan_in)
        rows = rows.withColumn("grp", F.floor(F.col("grp") / fan_in)).groupBy("grp").applyInArrow(together, _SUMMARY)
        if left <= 1:
            break
    found = rows.select("words").collect()
    return list(found[0][0]) if found else []


def with_token_counts(
    docs: DataFrame, path: str, text: str = "text", size: int = 8192, cache: int = 200_000, name: str = "n_tokens",
) -> DataFrame:
    """``docs`` with the number of tokens of each whole text, as the tokenizer file at ``path`` gives them without
    added tokens, truncation or padding.

    The lengths of the most frequent pre-tokens (``frequent_pre_tokens``, at most ``size``) are broadcast. All other
    pre-tokens are encoded where they stand, once per block of texts, and remembered by the Python worker across its
    tasks, up to ``cache`` of them. Both tables only
    save work: counts are the same without them. A null or empty text has 0 tokens; repeated rows are counted each.
    """
    tokenizer, _ = load(path)
    words = frequent_pre_tokens(docs, path, text, size)
    lengths = {w: len(e.ids) for w, e in zip(words, tokenizer.encode_batch(words, add_special_tokens=False))}
    table = docs.sparkSession.sparkContext.broadcast(lengths)

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, special = shared(path)
        split = splitter(special)
        merge, characters = encoder.model.tokenize, byte_characters()
        unsettled = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SETTLED) + "]")
        known = worker_store().setdefault(f"token lengths {path}", {})
        known.update(table.value)

        def counts(texts: list[str | None]) -> Iterator[int]:
            found = [
                None if t and not t.isascii() and unsettled.search(t) else split(t) if t else ((), 0) for t in texts
            ]
            new = list({p for f in found if f for p in f[0]} - known.keys())
            if len(known) + len(new) > cache + size:
                known.clear()
                known.update(table.value)
                new = list({p for f in found if f for p in f[0]} - known.keys())
            # A pre-token goes straight to the merges; cutting and mapping it again is what costs in the library.
            for p in new:
                known[p] = len(merge(p.encode().decode("latin-1").translate(characters)))
            for t, f in zip(texts, found):
                yield len(encoder.encode(t, add_special_tokens=False)) if f is None else f[1] + sum(map(known.__getitem__, f[0]))

        for texts in batches:
            blocks = in_blocks([pa.RecordBatch.from_arrays([texts], ["text"])], "text", 1 << 20)
            out = [n for block in blocks for n in counts(block.column(0).to_pylist())]
            yield pa.array(out, pa.int64())

    return docs.withColumn(name, count(F.col(text).cast("string")))
