"""The language model's query learns from training documents alone."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest
from brute import LOWER, words
from pyspark.sql import functions as F

from centerline.llm import language_model
from centerline.llm.queries import QUERIES


def rounded(estimate):
    """To the nearest sixteenth of a halving."""
    return 2 ** (round(math.log2(estimate) * 16) / 16) if estimate else 0.0


def brute_scores(docs):
    """Scores under weights learned from each training text by the counts of all the others."""
    tokens = [[*words((t or "").translate(LOWER)), None] for _, t in docs]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    pairs = [list(zip([None, *t[:-1]], t, [True, *[False] * (len(t) - 1)])) for t in tokens]
    single, double = Counter(), Counter()
    for t, p, h in zip(tokens, pairs, held):
        if not h:
            single.update(t)
            double.update(p)
    n, kinds = sum(single.values()), len(single)
    outcomes = Counter()
    for t, p, h in zip(tokens, pairs, held):
        if not h:
            own, two = Counter(t), Counter(p)
            for c, x, start in p:
                context = single[c] - own[c]
                pair, token = double[c, x, start] - two[c, x, start], single[x] - own[x]
                estimates = pair / context if context else 0.0, token / max(n - len(t), 1)
                outcomes[context.bit_length(), *map(rounded, estimates)] += 1
    weights = {}
    for _ in range(20):
        sums = {}
        for (b, *two), count in outcomes.items():
            estimates = *two, 1 / (kinds + 1)
            mixed = [w * e for w, e in zip(weights.get(b, [1 / 3] * 3), estimates)]
            own = sums.setdefault(b, [1.0, 1.0, 1.0])
            for k in range(3):
                own[k] += count * mixed[k] / sum(mixed)
        new = {b: [v / sum(own) for v in own] for b, own in sums.items()}
        moved = max(abs(a - z) for b in new for a, z in zip(new[b], weights.get(b, [1 / 3] * 3)))
        weights = new
        if moved < 1e-3:
            break
    return [
        sum(
            math.log10(sum(w * e for w, e in zip(
                weights.get(single[c].bit_length(), [1 / 3] * 3),
                (double[c, x, start] / single[c] if single[c] else 0.0, single[x] / max(n, 1), 1 / (kinds + 1)),
            )))
            for c, x, start in p
        )
        for p in pairs
    ]


@pytest.mark.parametrize("chunk", [8 << 20, 2000])
def test_weights_from_training(docs, rows, chunk):
    found = language_model.score_documents(docs, chunk_bytes=chunk).collect()
    want = Counter((i, round(s, 5)) for (i, _), s in zip(rows, brute_scores(rows)))
    assert Counter((r.doc_id, round(r.score, 5)) for r in found) == want


def test_held_out_texts_change_no_other_score(spark, docs, tmp_path):
    changed = docs.withColumn(
        "text", F.when(language_model.is_held_out(F.col("doc_id")), F.lit("w1 w1 w2, w1 other text")).otherwise(F.col("text"))
    )
    scores = []
    for name, df in (("one", docs), ("two", changed)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = QUERIES["op10_deleted_interpolation"](spark, f"{tmp_path}/{name}").collect()
        scores.append(Counter((r.doc_id, round(r.score, 6)) for r in found if not r.held_out))
        assert any(r.held_out for r in found)
    assert scores[0] == scores[1]
