"""Repeated passages by sparse suffix arrays: suffixes at content-selected positions, sorted and compared."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.llm import repeats
from centerline.llm.common import mix


def minimisers(length: int) -> repeats.Anchors:
    """Anchors by the smallest hash of ``length`` words: the suffixes that are retained start where it stands."""

    def anchors(first: np.ndarray, second: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(first)
        stop = np.minimum(np.arange(n) + length, n)
        seeds = repeats.Rolling(second, 1).of(np.arange(n), stop)
        return mix(seeds), seeds

    return anchors


def suffix_dedup(
    docs: DataFrame, min_words: int = 50, seed_words: int = 20, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans, kept_sha256, text``.

    Every word that lies in ``min_words`` consecutive words which also start earlier in the corpus (smaller id, or same
    document and earlier start) is removed; ``spans`` are the word positions ``[start, stop)``. Judged on the input.

    Suffixes are retained where the smallest hash of ``seed_words`` words within ``min_words`` stands, about one in
    ``(min_words - seed_words) / 2`` words. They are sorted by the words they start with, then by the words around
    them as far as the window reaches, then by place, and compared with their neighbours; a match is extended left and
    right to all the words of the repeated windows. Two windows of ``min_words`` equal words retain a suffix at the
    same place, so no repeat of that length is missed.

    Null texts have no words and stay null; a null id counts as larger than all others; rows that repeat id and text
    are no repeats of each other; an empty table gives no rows.
    """
    if not 0 < seed_words <= min_words:
        raise ValueError("seed_words must lie between 1 and min_words")
    rows = repeats.keyed(docs, doc_id, text, [F.col(doc_id).alias("own_id")])
    found = repeats.without_repeats(rows, min_words, seed_words, minimisers(seed_words))
    return found.select(F.col("own_id").alias("doc_id"), "n_words", "n_removed", "spans", "kept_sha256", "text")


def with_repeats_cut(
    docs: DataFrame, min_words: int = 50, seed_words: int = 20, doc_id: str = "doc_id", text: str = "text",
    length: str | None = "n_chars",
) -> DataFrame:
    """The documents with all their columns, repeated passages cut from the text, and ``length``, if given and there,
    set to the code points left. A document of which no word is left has an empty text."""
    rows = repeats.keyed(docs, doc_id, text, [F.struct("*").alias("doc")])
    found = repeats.without_repeats(rows, min_words, seed_words, minimisers(seed_words))
    changed = F.col("n_removed") > 0
    out = F.col("doc").withField(text, F.when(changed, F.col("text")).otherwise(F.col(f"doc.{text}")))
    if length in docs.columns:
        kind = docs.schema[length].dataType
        out = out.withField(length, F.when(changed, F.length("text").cast(kind)).otherwise(F.col(f"doc.{length}")))
    return found.select(out.alias("doc")).select("doc.*")
