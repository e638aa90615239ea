"""Quality rules whose cutoffs are chosen by exact bounds on labelled documents."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centerline.llm.common import Vocabulary, batch_of, mapped, mix, texts_of, written

SYMBOLS = "#*$%&|<>"
RUN = 5

_FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MEASURES = "struct<" + ",".join(f"{f}:long" for f in _FIELDS) + ">"

# Rules: a measure that is larger in worse texts, and the cutoffs that may be chosen, loosest first.
RULES: dict[str, tuple[str, tuple[float, ...]]] = {
    "symbols": ("try_divide(n_symbols, n_words)", (3.0, 2.5, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05)),
    "dup_lines": ("try_divide(n_dup_lines, n_lines)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    "repeats": ("try_divide(n_repeat_words, n_words)", (0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06)),
    "long_words": ("try_divide(word_chars, n_words)", (20.0, 15.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5)),
    "short_words": ("-try_divide(word_chars, n_words)", (-1.0, -1.5, -2.0, -2.5, -3.0, -3.5, -4.0, -4.5)),
}


def _repeat_words(ids: np.ndarray) -> int:
    """Words in runs of ``RUN`` words that stand twice or more in the text, the first one included."""
    n = len(ids) - RUN + 1
    if n < 2:
        return 0
    code = mix(ids[:n].astype(np.uint64))
    for k in range(1, RUN):
        code = mix(code + ids[k:n + k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    equal = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + RUN, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + RUN, -1)
    return int((np.cumsum(edge)[: len(ids)] > 0).sum())


def measure(text: bytes, vocabulary: Vocabulary) -> tuple[int, ...]:
    """The counts of one text, in the order of ``_FIELDS``."""
    words = text.split()
    whole = text.decode("utf-8", "replace")
    word_chars = len(whole) - sum(whole.count(c) for c in " \t\n\x0b\x0c\r")
    n_symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    lines = [line for line in text.split(b"\n") if line.strip()]
    vocabulary.trim()
    repeated = _repeat_words(vocabulary.numbers(words)) if len(words) > RUN else 0
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measures(text: Column) -> Column:
    """A struct of the counts of a text; all are 0 for a null or empty text."""

    @F.arrow_udf(MEASURES)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = Vocabulary(250_000)
        for texts in batches:
            rows = [measure(t, vocabulary) if t else (0,) * len(_FIELDS) for t in texts_of(texts)]
            columns = np.array(rows, dtype=np.int64).reshape(-1, len(_FIELDS)).T
            yield pa.StructArray.from_arrays([pa.array(c) for c in columns], list(_FIELDS))

    return measured(text.cast("string"))


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < 10) | (F.col(f"{m}.n_repeat_words") * 100 > F.col(f"{m}.n_words") * 20)


def _value(rule: str, m: str) -> Column:
    return F.expr(re.sub("|".join(_FIELDS), lambda name: f"{m}.{name[0]}", RULES[rule][0]))


def tail_chance(failures: int, trials: int, rate: float) -> float:
    """Chance of so few failures or fewer, each trial failing at ``rate``: exact (binomial)."""
    if failures >= trials:
        return 1.0
    odds = math.log(rate) - math.log1p(-rate)
    term = trials * math.log1p(-rate)
    logs = [term]
    for k in range(failures):
        term += math.log(trials - k) - math.log(k + 1) + odds
        logs.append(term)
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


CHOOSING = "5"  # ids whose MD5 begins with a smaller digit choose cutoffs: 5 in 16

LEAST_GAIN = 20  # a rule has to reject one bad document in so many

_TESTED = "stratum string,clean long,clean_lost long,bad long,bad_gone long,chance double"


def _tested(risk: float):
    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c) for c in ("stratum", "clean", "clean_lost", "bad", "bad_gone")}
            found = [tail_chance(x, n, risk) for x, n in zip(batch.column("clean_lost").to_pylist(), batch.column("clean").to_pylist())]
            yield batch_of({**columns, "chance": pa.array(found, pa.float64())})

    return tested


def learn_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row per stratum: the cutoff of each rule (null: the rule rejects nothing there), and what the test found
    (``clean, clean_lost, bad, bad_gone, chance, allowed``).

    ``measured`` has ``doc_id, stratum, m``; ``labels`` has ``doc_id, quality`` (1 clean, 0 bad; rows with nulls are
    left out, and an id with both counts as bad). Only labelled documents that the base rules pass are counted.

    Some of them, by a hash of the id, choose, one rule after the other. Of its listed cutoffs that no clean one of the
    stratum passes, a rule gets the loosest that as many bad ones pass as any, of those that the rules before it leave;
    and only if these are a twentieth of all bad ones. The others test the rules of a stratum together, once: if a share
    ``risk`` of clean documents were rejected or more, so few rejections as were seen would have at most the chance
    ``chance`` (exact, binomial). Holm's procedure over the strata allows those whose chances are small enough for
    all allowed strata to hold together, but with chance ``error``; the others get no cutoffs. At 0.02 and 0.05 a
    stratum needs 149 clean labels to test with, and up to 217 if it is the first of four. All counting is
    aggregation; what is left is one row per stratum.
    """
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chooses = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) < CHOOSING
    known = written(
        measured.where(~base_failed("m")).join(marks.where("quality IN (0, 1)"), "doc_id").select("stratum", "m", "quality", chooses.alias("chooses")),
        "quality-known",
    )
    left = known.where("chooses")
    chosen = written(left.groupBy("stratum").agg(F.count_if(F.col("quality") == 0).alias("all_bad")), "quality-chosen")
    for rule, (_, cutoffs) in RULES.items():
        over = {
            (i, q): F.count_if((F.col("quality") == q) & (_value(rule, "m") > c)).alias(f"over_{q}_{i}")
            for i, c in enumerate(cutoffs) for q in (0, 1)
        }
        safe = [F.when(F.col(f"over_1_{i}") == 0, F.col(f"over_0_{i}")) for i in range(len(cutoffs))]
        most = F.coalesce(F.greatest(*safe), F.lit(0))
        enough = (most > 0) & (most * LEAST_GAIN >= F.col("all_bad"))
        loosest = F.coalesce(*[F.when(enough & (n == most), F.lit(c)) for n, c in zip(safe, cutoffs)])
        counted = left.groupBy("stratum").agg(*over.values())
        chosen = written(chosen.join(counted, "stratum", "left").select(*chosen.columns, loosest.alias(rule)), "quality-chosen")
        cut = chosen.select("stratum", F.col(rule).alias("_cut"))
        passed = F.coalesce(_value(rule, "m") > F.col("_cut"), F.lit(False))
        left = left.join(cut, "stratum", "left").where(~passed).drop("_cut")
    judged = _with_cutoffs(known.where("NOT chooses"), chosen).select(
        "stratum", "quality", (F.size(broken_rules("m")) > 0).alias("gone")
    )
    tests = judged.groupBy("stratum").agg(*[
        F.count_if((F.col("quality") == q) & (F.col("gone") | F.lit(whole))).alias(name)
        for name, q, whole in (("clean", 1, True), ("clean_lost", 1, False), ("bad", 0, True), ("bad_gone", 0, False))
    ])
    by_chance = Window.orderBy("chance", "stratum")
    ranked = mapped(tests, _tested(risk), _TESTED).withColumn(
        "fine", F.col("chance") <= F.lit(float(error)) / (F.count("*").over(Window.partitionBy()) - F.row_number().over(by_chance) + 1)
    )
    allowed = F.every("fine").over(by_chance.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = chosen.drop("all_bad").join(ranked.withColumn("allowed", allowed).drop("fine"), "stratum", "left")
    cutoffs = [F.when(F.coalesce("allowed", F.lit(False)), F.col(rule)).alias(rule) for rule in RULES]
    return written(found.select("stratum", *cutoffs, "clean", "clean_lost", "bad", "bad_gone", "chance", "allowed"), "quality-cutoffs")


def broken_rules(m: str) -> Column:
    """Names of the rules a document breaks, given its measures and its stratum's cutoffs as columns."""
    return F.array_compact(F.array(*[
        F.when(_value(rule, m) > F.col(f"cut.{rule}"), F.lit(rule)) for rule in RULES
    ]))


def _with_cutoffs(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    cut = cutoffs.select(F.col("stratum").alias("cut_stratum"), F.struct(*RULES).alias("cut"))
    return measured.join(cut, F.col("stratum") == F.col("cut_stratum"), "left").drop("cut_stratum")


def judge(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
    **options,
) -> DataFrame:
    """One row per document: ``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    base_failed, broken, kept``.

    The base rules reject texts of under 10 words or with more than a fifth of words in repeated runs. Others are
    kept unless they break a rule with a cutoff of their stratum (``learn_cutoffs``; ``options`` go there). A null
    text has no words and fails; a null stratum is the stratum ``''``; repeated rows are judged each; without labels
    only the base rules reject. Texts are read once, their counts are written and used for both learning and judging.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        measures(F.col(text)).alias("m"),
    )
    measured = written(rows, "quality-measures")
    cutoffs = learn_cutoffs(measured, labels, **options)
    return (
        _with_cutoffs(measured, cutoffs)
        .select("doc_id", "stratum", "m.*", base_failed("m").alias("base_failed"), broken_rules("m").alias("broken"))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    )


def without_rejected(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", **options,
) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns and unchanged.

    Nulls, repeated rows and an empty table are as in ``judge``; columns may have any names. Texts are measured once:
    documents are written with their counts, and both learning and judging read these.
    """
    rows = written(docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), measures(F.col(text)).alias("m"),
    ), "quality-rows")
    cutoffs = learn_cutoffs(rows.select("doc_id", "stratum", "m"), labels, **options)
    kept = _with_cutoffs(rows, cutoffs).where(~base_failed("m") & (F.size(broken_rules("m")) == 0))
    return kept.select("doc.*")
