"""Each operator against a brute-force version, on texts with every odd case."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from centerline.llm import (
    components, decontaminate, language_model, pages, pieces, quality, recompression, sharding, simhash, suffixes, tokens,
)

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def bag(rows):
    return Counter(map(repr, rows))


@pytest.mark.parametrize("window", [50, 20, 7])
def test_suffix_dedup(docs, rows, window):
    found = suffixes.suffix_dedup(docs, window, max(1, window * 2 // 5)).collect()
    want = [(i, len(w), len(gone), brute.digest(w, gone)) for (i, _), (w, gone) in zip(rows, brute.repeats(rows, window))]
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == bag(want)
    assert any(n for _, _, n, _ in want)
    assert all(r.n_removed == sum(s.stop - s.start for s in r.spans) for r in found)


@pytest.mark.parametrize("window, rounds", [(20, 4), (20, 1), (8, 3)])
def test_recompression_dedup(docs, rows, window, rounds):
    found = recompression.recompression_dedup(docs, window, rounds).collect()
    want = [(i, len(w), len(gone), brute.digest(w, gone)) for (i, _), (w, gone) in zip(rows, brute.repeats(rows, window))]
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == bag(want)


def test_cut_text_keeps_columns_and_white_space(docs, rows):
    found = suffixes.with_repeats_cut(docs, 50)
    assert found.columns == docs.columns
    want = []
    for (i, t), (_, gone) in zip(rows, brute.repeats(rows, 50)):
        new = brute.cut_text(t, gone)
        want.append((i, new, None if new is None else len(new), 7))
    assert bag((r.doc_id, r.text, r.n_chars, r.shard) for r in found.collect()) == bag(want)


def test_quality_counts(docs, rows, labels):
    found = quality.judge(docs, labels).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    want = []
    for i, t in rows:
        m = brute.measures(t)
        want.append((i, *(m[x] for x in names), brute.base_failed(m)))
    assert bag((r.doc_id, *(r[x] for x in names), r.base_failed) for r in found) == bag(want)
    assert all(r.kept == (not r.base_failed and not r.broken) for r in found)


def test_quality_cutoffs_bound_false_rejections(spark):
    rows = [(i, "clean words stand here and no two of them are ever alike now " + str(i), "en") for i in range(900)]
    rows += [(i, "junk ### text with $$$ signs in it and more &&& of them ||| everywhere " + str(i), "en") for i in range(900, 1000)]
    rows += [(i, "junk ### text with $$$ signs in it and more &&& of them ||| everywhere " + str(i), "xx") for i in range(1000, 1010)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 900)) for i in range(1010)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.judge(docs, labels).collect()}
    assert all(found[i].kept for i in range(900))
    assert not any(found[i].kept for i in range(900, 1000))
    assert all(found[i].kept for i in range(1000, 1010))  # no clean labels there, so no cutoffs
    kept = quality.without_rejected(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


def test_tail_chance_is_exact():
    for k, n, p in ((0, 300, 0.05), (3, 1000, 0.01), (20, 50, 0.3), (5, 5, 0.1), (0, 0, 0.02)):
        want = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
        assert quality.tail_chance(k, n, p) == pytest.approx(1.0 if k >= n else want, rel=1e-9)


def test_strata_of_a_few_hundred_labels_get_cutoffs(spark):
    """Holm's procedure: strata of 400 labels pass, one of 40 does not, and it takes nothing from the others."""
    good, junk = "words stand here and no two of them are ever alike now ", "junk ### text with $$$ signs in it and more &&& of them ||| all "
    rows, labels = [], []
    for stratum, n in (("aa", 400), ("bb", 400), ("cc", 40), ("dd", 600)):
        for i in range(n):
            number = len(rows)
            bad = i % 8 == 0
            rows.append((number, (junk if bad else good) + str(number), stratum))
            labels.append((number, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = quality.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    kept = Counter((r.stratum, "junk" in rows[r.doc_id][1], r.kept) for r in judged)
    assert all(kept[s, False, False] == 0 for s in ("aa", "bb", "cc", "dd"))
    assert all(kept[s, True, True] == 0 and kept[s, True, False] for s in ("aa", "bb", "dd"))
    assert kept["cc", True, False] == 0


def test_false_rejections_stay_below_the_risk():
    """Strata whose true rate is just over the risk are allowed in at most the promised share of trials."""
    rng = np.random.default_rng(4)
    trials, wrong = 3000, 0
    for _ in range(trials):
        tests = [(int(rng.binomial(n, rate)), n, rate) for n, rate in ((250, 0.0201), (340, 0.0), (900, 0.0201), (200, 0.0201))]
        chances = sorted((quality.tail_chance(x, n, 0.02), rate) for x, n, rate in tests)
        for place, (chance, rate) in enumerate(chances):
            if chance > 0.05 / (len(chances) - place):
                break
            if rate > 0.02:
                wrong += 1
                break
    assert wrong / trials < 0.05 + 3 * (0.05 * 0.95 / trials) ** 0.5


@pytest.mark.parametrize("shards", [8, 3, 1])
def test_balanced_shards(docs, rows, shards):
    found = sharding.balanced_shards(docs, shards).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert bag((r.doc_id, r.size, r.text_crc32) for r in found) == bag(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows
    )
    by = sorted(found, key=lambda r: (r.shard, r.slot))
    order = [(r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size) for r in by]
    assert order == sorted(order)
    total, at = sum(r.size for r in by), 0
    for r in by:
        assert r.shard == at * shards // total
        at += r.size
    for s in {r.shard for r in by}:
        assert [r.slot for r in by if r.shard == s] == list(range(sum(r.shard == s for r in by)))


@pytest.mark.parametrize("size, cache", [(8192, 200_000), (3, 5)])
def test_token_counts(docs, rows, size, cache):
    library, _ = tokens.load(BPE)
    found = tokens.with_token_counts(docs, BPE, size=size, cache=cache)
    assert found.columns == [*docs.columns, "n_tokens"]
    want = [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert bag((r.doc_id, r.n_tokens) for r in found.collect()) == bag(want)


def test_token_counts_of_disputed_characters(spark):
    library, _ = tokens.load(BPE)
    texts = ["a" + chr(c) + "1 " + chr(c) + "b" for c in (0x558, 0xC5C, 0xA7CE, 0x10940, 0x18E00, 0x323B0, 0x1F600, 0x85)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in tokens.with_token_counts(docs, BPE).collect()}
    assert found == {i: len(library.encode(t, add_special_tokens=False)) for i, t in enumerate(texts)}


def test_frequent_pre_tokens_are_the_frequent_ones(docs):
    assert set(tokens.frequent_pre_tokens(docs, BPE, size=64, fan_in=2)) >= {" a"}


def test_near_duplicates(docs, rows):
    prints = [brute.fingerprint(t) for _, t in rows]
    roots = brute.linked(prints)
    least = {}
    for root, (i, _) in zip(roots, rows):
        if i is not None:
            least[root] = min(least.get(root, i), i)
    found = simhash.near_duplicates(docs).collect()
    assert bag((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found) == bag(
        (i, p, least.get(root)) for (i, _), p, root in zip(rows, prints, roots)
    )
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(roots))
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == set(least.values())


def test_links_find_all_pairs(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    prints = set(centre.tolist())
    for c in centre.tolist():
        for _ in range(30):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            prints.add(c ^ int(sum(1 << int(b) for b in flips)))
    prints = [p - (1 << 64) if p >= 1 << 63 else p for p in prints] + [0, -1]
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).distinct().collect()
    want = {
        (min(a, b), max(a, b)) for i, a in enumerate(prints) for b in prints[:i]
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
    }
    assert {(r.u, r.v) for r in found} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(5, 5), (None, 3), (7, None)]
    found = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 160)}
    assert len(found) == 121


def test_contamination(docs, rows, items, benchmark):
    for block in (8 << 20, 50):
        found = decontaminate.contamination(docs, benchmark, block_bytes=block).collect()
        want = [(i, *brute.hits(t, items), brute.contaminated(t, items)) for i, t in rows]
        assert bag((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found) == bag(want)
    assert any(x[-1] for x in want)
    kept = decontaminate.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert bag((r.doc_id, r.text) for r in kept.collect()) == bag(x for x in rows if not brute.contaminated(x[1], items))


def test_language_model(docs, rows):
    want, n = brute.lm(rows)
    for chunk in (8 << 20, 2000):
        found = language_model.score_documents(docs, chunk_bytes=chunk).collect()
        assert {r.train_tokens for r in found} == {n}
        short = lambda x: round(x, 6)
        assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, short(r.base_score)) for r in found) == bag(
            (i, *map(lambda v: v if not isinstance(v, float) else short(v), w)) for (i, _), w in zip(rows, want)
        )


def test_pieces_come_back_and_are_reproducible(spark, docs, rows):
    found = pieces.with_pieces(docs, PIECES).collect()
    again = pieces.with_pieces(docs.repartition(2), PIECES).collect()
    assert bag(map(tuple, found)) == bag(map(tuple, again))
    assert all(r.lossless for r in found) and all(r.n_pieces == len(r.ids) for r in found)
    back = docs.select("doc_id", "text", pieces.sampled(F.col("text"), F.col("doc_id"), PIECES, seed=9).alias("s"))
    assert all((t or "") == b for t, b in back.select("text", pieces.decoded(F.col("s.ids"), PIECES)).collect())
    assert any(a.ids != b.ids for a, b in zip(found, pieces.with_pieces(docs, PIECES, seed=1).collect()))


def test_pieces_are_drawn_by_their_chances():
    model = pieces.Pieces(PIECES)
    known = {b.decode(): i for i, b in enumerate(model.bytes) if b and i > 258}

    def ways(s):
        if not s:
            yield ()
        for n in range(1, len(s) + 1):
            if s[:n] in known:
                yield from ((known[s[:n]], *rest) for rest in ways(s[n:]))

    n, alpha = 20_000, 0.7
    ids, count = pieces.segment(["tion"] * n, np.arange(n), model, alpha, 3)
    ends = np.cumsum(count)
    drawn = Counter(tuple(ids[b - c:b].tolist()) for b, c in zip(ends, count))
    weight = {w: math.exp(alpha * sum(model.logs[i] for i in w)) for w in ways(" tion")}
    total = sum(weight.values())
    assert set(drawn) <= set(weight)
    assert all(abs(drawn[w] / n - v / total) < 0.02 for w, v in weight.items())
    lattice = pieces.Lattice([" tion"], model, alpha)
    assert lattice.log_total[0] == pytest.approx(math.log(total))


@pytest.mark.parametrize("text", ["the on", "né\nin", "a龘b", "of 😀the", "  it", "in\n\non", "\x07"])
def test_texts_of_several_parts_and_characters_without_piece(text):
    """All segmentations of the whole text, by the pieces that fit and the bytes of characters that are no piece."""
    model = pieces.Pieces(PIECES)
    special = {int(i) for i in model.byte_ids}
    known = {b.decode(): i for i, b in enumerate(model.bytes) if b and i not in special}

    def ways(s):
        if not s:
            yield (), 0.0
        for n in range(1, len(s) + 1):
            if s[:n] in known:
                yield from (((known[s[:n]], *rest), model.logs[known[s[:n]]] + log) for rest, log in ways(s[n:]))
        if s and s[0] not in known:  # its weight is in every segmentation
            yield from (((*(int(model.byte_ids[b]) for b in s[0].encode()), *rest), log) for rest, log in ways(s[1:]))

    n, alpha = 20_000, 0.6
    weight = {w: math.exp(alpha * log) for w, log in ways(" " + text)}
    ids, count = pieces.segment([text] * n, np.arange(n), model, alpha, 5)
    ends = np.cumsum(count)
    drawn = Counter(tuple(ids[b - c:b].tolist()) for b, c in zip(ends, count))
    total = sum(weight.values())
    assert set(drawn) <= set(weight)
    assert all(abs(drawn[w] / n - v / total) < 0.02 for w, v in weight.items())
    assert all(model.decode(list(w)) == text.encode() for w in drawn)


PAGE = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use, cookies, a lot.</div>
%s<aside>Also, here</aside><div id="comments"><p>First, nice, text, this, is, long, enough to win points.</p></div>
<form><p>Name, please</p></form><footer>End</footer><script>var x="<p>no</p>";</script></body></html>"""


@pytest.mark.parametrize("body, want", [
    ("<article><h1>A &amp; B</h1><p>One,\n two<br>three <b>bo</b>ld<p>Next &eacute;&#x41;</article>",
     "A & B\n\nOne, two three bold\n\nNext éA"),
    ("<div class=post><h2>Head</h2><p>Some, text, with commas in it.</p><div class='ad-slot'>Buy</div><p>Last.</p></div>"
     "<div><a href=x>more of the links</a></div>", "Head\n\nSome, text, with commas in it.\n\nLast."),
    ("<main><section><p>Part one, which is long enough.</p></section><section><p>Part two.</p><ul><li>x<li>y</ul></section></main>",
     "Part one, which is long enough.\n\nPart two.\n\nx\n\ny"),
    ("<article><p>Text, that counts.</p><section class=comments><p>So, so, so, so, good</p></section></article>", "Text, that counts."),
    ("<article><p>a<table><tr><td>1<td>2</table></article>", "a\n\n1\n\n2"),
])
def test_main_text(body, want):
    assert pages.main_text(PAGE % body) == want


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain, text", "plain, text"), ("<p>x", "x"), ("</p>y", "y"), ("<", "<"), ("<nav>x", ""),
    ("<div>" * 2000 + "x", "x"), ("<script>x", ""), ("<!-- x", ""), ("a<b>c</b>", "ac"),
])
def test_odd_pages(page, want):
    assert pages.main_text(page) == want


def test_pages_column(spark):
    rows = [(1, "u", PAGE % "<article><p>Yes</p></article>", "x"), (2, None, None, "x"), (2, None, None, "x")]
    found = pages.with_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, tree string"))
    assert [r.text for r in found.orderBy("page_id").collect()] == ["Yes", "", ""]


def test_empty_tables(spark, nothing, benchmark, labels, docs):
    no_items, no_labels = benchmark.limit(0), labels.limit(0)
    for df in (
        suffixes.suffix_dedup(nothing), recompression.recompression_dedup(nothing), suffixes.with_repeats_cut(nothing),
        quality.judge(nothing, labels), quality.without_rejected(nothing, no_labels), sharding.balanced_shards(nothing),
        tokens.with_token_counts(nothing, BPE), simhash.near_duplicates(nothing), simhash.one_of_each(nothing),
        decontaminate.contamination(nothing, benchmark), language_model.score_documents(nothing),
        pieces.with_pieces(nothing, PIECES), pages.with_main_text(nothing.withColumn("html", F.col("text"))),
    ):
        assert df.count() == 0
    assert decontaminate.without_contaminated(docs, no_items).count() == docs.count()
    assert quality.judge(docs, no_labels).where("base_failed = kept").count() == 0


def test_tables_of_a_benchmark_block_are_small():
    import random

    rng = random.Random(1)
    items = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) + str(rng.randrange(10**5)) for _ in range(200)).encode()) for i in range(400)]
    size = sum(len(t) for _, t in items)
    tables = decontaminate.tables_of(items, 13)
    held = sum(len(t.text) + len(t.shift) + sum(getattr(t, x).nbytes for x in ("ends", "begin", "stop", "items", "held")) for t in tables)
    assert held < 10 * size
    body = decontaminate.words_of(b"x y " + items[7][1] + b" z")
    assert [s for t in tables for s, held in t.occurrences(body) if held.tolist() == [7]] == list(range(2, 190))


def test_long_items_are_cut_without_loss(spark, docs, rows, benchmark, items):
    long = " ".join(t for _, t in rows[:40] if t)
    wide = spark.createDataFrame([*items, (77, long), (78, long + " end"), (77, long)], "item_id long, text string")
    every = [*items, (77, long), (78, long + " end")]
    some = {i for i, _ in rows[:60]}
    found = decontaminate.contamination(docs.where(F.col("doc_id").isin(*some - {None})), wide, block_bytes=2000).collect()
    want = [(i, *brute.hits(t, every)) for i, t in rows if i in some and i is not None]
    assert bag((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found) == bag(want)
