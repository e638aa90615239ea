"""Repeated passages by recompression: runs and pairs of tokens are named, round after round."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.llm import repeats
from centerline.llm.common import mix

U = np.uint64


def interior_symbols(reach: int, rounds: int = 4) -> repeats.Anchors:
    """Anchors by the symbols of ``rounds`` rounds of recompression.

    In a round every run of one symbol, together with a run behind it if a coin says left for the first symbol and
    right for the second, becomes one symbol. Its name is a hash of the two symbols and how often they stand, and the
    coin is a bit of the symbol's name, so all documents name alike with no table of names to share.

    What a symbol is depends on its words and on one symbol of the round before to either side: these words are its
    evidence. Equal stretches of text that hold the evidence hold the symbol. An anchor is a symbol with evidence of
    at most ``reach`` words, placed where that begins; those of later rounds come first.
    """

    def anchors(first: np.ndarray, second: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(first)
        place = np.arange(n)
        stop = place + behind  # end of the document
        start = np.concatenate(([True], stop[1:] != stop[:-1]))  # first word of a document
        begin = np.maximum.accumulate(np.where(start, place, 0))
        name, left, right, document = mix(second), place, place + 1, begin
        best = (U(rounds) << U(61)) | (mix(name) >> U(3))
        width = np.ones(n, dtype=np.int64)
        for level in range(1, rounds + 1):
            joined = document[1:] == document[:-1]
            equal = joined & (name[1:] == name[:-1])
            coin = (mix(name + U(level)) & U(1)).astype(bool)
            glued = equal | (joined & ~coin[:-1] & coin[1:] & ~equal)
            head = np.flatnonzero(np.concatenate(([True], ~glued)))
            tail = np.concatenate((head[1:], [len(name)])) - 1
            count = tail - head + 1
            pairs = np.concatenate(([0], np.cumsum(glued & ~equal)))
            paired = pairs[tail] > pairs[head]
            same_as_first = np.add.reduceat((name == np.repeat(name[head], count)).astype(np.int64), head)
            lead = np.where(paired, same_as_first, count)
            named = mix(mix(mix(name[head]) + lead.astype(U)) ^ mix(name[tail] + (count - lead).astype(U) * U(_STEP)))
            before = np.maximum(head - 1, 0)
            after = np.minimum(tail + 1, len(name) - 1)
            inner = (head > 0) & (document[before] == document[head]) & (document[after] == document[tail]) & (tail + 1 < len(name))
            # Without a neighbour in the document there is no evidence that would hold elsewhere.
            new_left = np.where(inner, left[before], -n)
            new_right = np.where(inner, right[after], 2 * n)
            name = np.where(count > 1, named, name[head])
            document, left, right = document[head], new_left, new_right
            size = right - left
            good = np.flatnonzero((size <= reach) & (left >= 0) & (right <= n))
            key = (U(rounds - level) << U(61)) | (mix(name[good] + U(level)) >> U(3))
            order = np.lexsort((key, left[good]))
            at = left[good][order]
            only = np.concatenate(([True], at[1:] != at[:-1])) if len(at) else np.zeros(0, dtype=bool)
            at, key, wide = at[only], key[order][only], size[good][order][only]
            better = key < best[at]
            best[at[better]] = key[better]
            width[at[better]] = wide[better]
        seeds = repeats.Rolling(second, 1).of(place, np.minimum(place + width, n)) ^ mix(best)
        return best, seeds

    return anchors


# Odd constant that tells the two runs of a pair apart.
_STEP = 0x9E3779B97F4A7C15


def recompression_dedup(
    docs: DataFrame, window: int = 20, rounds: int = 4, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans, kept_sha256, text``.

    Every word in a window of ``window`` words that also starts earlier in the corpus is removed (see ``repeats``).
    Shared symbols of the recompressed documents (``interior_symbols``) bring equal windows together; the words of the
    windows themselves then decide, so a symbol that occurs in different surroundings removes nothing.

    Null texts have no words and stay null; a null id counts as larger than all others; rows that repeat id and text
    are no repeats of each other; an empty table gives no rows.
    """
    reach = max(1, window // 2)
    rows = repeats.keyed(docs, doc_id, text, [F.col(doc_id).alias("own_id")])
    found = repeats.without_repeats(rows, window, reach, interior_symbols(reach, rounds))
    return found.select(F.col("own_id").alias("doc_id"), "n_words", "n_removed", "spans", "kept_sha256", "text")
