"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from centerline.llm import (
    decontaminate, filter_audit, hard_negatives, language_model, pages, pieces, quality, recompression, records, sharding,
    simhash, suffixes, tokens,
)
from centerline.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_suffix_dedup(spark, sf):
    found = suffixes.suffix_dedup(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", _span_list(F.col("spans")).alias("spans"))


def _span_list(spans: Column) -> Column:
    """Spans as text: ``start-stop`` in word positions from 0, parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["start"], F.lit("-"), s["stop"])), ",")


def _repeats_sql(window: int) -> str:
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
x AS (
  SELECT r, id, s, array_to_string(w[s:s + {window - 1}], ' ') AS passage
  FROM (SELECT r, id, w, unnest(range(1, len(w) - {window} + 2)) AS s FROM d)),
e AS (SELECT passage, min(row(id, s)) AS earliest FROM x GROUP BY passage HAVING count(*) > 1),
c AS (
  SELECT DISTINCT r, unnest(range(s, s + {window})) AS pos FROM x JOIN e USING (passage) WHERE row(id, s) <> earliest),
p AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
k AS (
  SELECT r, string_agg(word, ' ' ORDER BY pos) AS kept FROM p ANTI JOIN c USING (r, pos) GROUP BY r),
i AS (SELECT r, pos, pos - row_number() OVER (PARTITION BY r ORDER BY pos) AS island FROM c),
s AS (SELECT r, min(pos) - 1 AS a, max(pos) AS b FROM i GROUP BY r, island),
n AS (SELECT r, sum(b - a) AS n_removed, string_agg(a || '-' || b, ',' ORDER BY a) AS spans FROM s GROUP BY r)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN k USING (r) LEFT JOIN n USING (r)"""


ORACLES["op1_suffix_dedup"] = _repeats_sql(50)


@query
def op2_quality_rules(spark, sf):
    judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "stratum", F.array_join("broken", ",").alias("broken"),
    )


def _quality_sql(risk: float = 0.02, error: float = 0.05) -> str:
    """The rules in SQL; a stratum's test passes if so few failures have a small enough chance at the risk."""
    names = list(quality.RULES)
    values = {
        "symbols": "n_symbols / nullif(n_words, 0)", "dup_lines": "n_dup_lines / nullif(n_lines, 0)",
        "repeats": "n_repeat_words / nullif(n_words, 0)", "long_words": "word_chars / nullif(n_words, 0)",
        "short_words": "-(word_chars / nullif(n_words, 0))",
    }
    cutoffs = ", ".join(
        f"({n}, '{name}', {i}, {float(c)!r}::DOUBLE)"
        for n, name in enumerate(names) for i, c in enumerate(quality.RULES[name][1])
    )
    measured = " UNION ALL ".join(f"SELECT r, '{name}' AS rule, {values[name]} AS value FROM m" for name in names)
    # One rule after the other: cutoffs that no clean document passes, and the bad ones that the rules before it leave.
    chosen = ",\n".join(f"""n{n} AS (
  SELECT stratum, rule, cutoff, i, count(*) FILTER (WHERE quality = 0 AND value > cutoff) AS bad_over, max(all_bad) AS all_bad
  FROM k{n} JOIN v USING (r) JOIN c USING (rule) WHERE rule = '{name}' GROUP BY ALL
  HAVING count(*) FILTER (WHERE quality = 1 AND value > cutoff) = 0),
q{n} AS (
  SELECT stratum, rule, cutoff FROM n{n} WHERE bad_over > 0 AND {quality.LEAST_GAIN} * bad_over >= all_bad
  QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY bad_over DESC, i) = 1),
k{n + 1} AS (
  SELECT k{n}.* FROM k{n} LEFT JOIN q{n} USING (stratum) LEFT JOIN v ON v.r = k{n}.r AND v.rule = '{name}'
  WHERE NOT coalesce(value > cutoff, false))""" for n, name in enumerate(names))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
x AS (
  SELECT r, s, array_to_string(w[s:s + 4], ' ') AS run FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS s FROM d)),
y AS (
  SELECT r, count(DISTINCT pos) AS n FROM (
    SELECT r, unnest(range(s, s + 5)) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY r, run) AS n FROM x) WHERE n > 1)
  GROUP BY r),
m AS (
  SELECT d.r, doc_id, stratum, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda v: length(v))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed
  FROM d LEFT JOIN y ON d.r = y.r),
v AS ({measured}),
k AS (
  SELECT r, stratum, quality, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '{quality.CHOOSING}' AS chooses FROM m JOIN (
    SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1)
    USING (doc_id) WHERE NOT base_failed AND quality IN (0, 1)),
c(place, rule, i, cutoff) AS (VALUES {cutoffs}),
k0 AS (SELECT r, stratum, quality, count(*) FILTER (WHERE quality = 0) OVER (PARTITION BY stratum) AS all_bad FROM k WHERE chooses),
{chosen},
q AS ({" UNION ALL ".join(f"SELECT * FROM q{n}" for n in range(len(names)))}),
g AS (
  SELECT k.r, k.stratum, quality, bool_or(value > cutoff) AS gone FROM k JOIN v ON v.r = k.r
  LEFT JOIN q ON q.stratum = k.stratum AND q.rule = v.rule WHERE NOT chooses GROUP BY ALL),
t AS (
  SELECT stratum, count(*) FILTER (WHERE quality = 1) AS clean, count(*) FILTER (WHERE quality = 1 AND gone) AS lost FROM g
  GROUP BY 1),
p AS (
  SELECT stratum, CASE WHEN lost >= clean THEN 1.0 ELSE list_sum(list_transform(range(lost + 1),
    lambda j: exp(lgamma(clean + 1) - lgamma(j + 1) - lgamma(clean - j + 1) + j * ln({risk}) + (clean - j) * ln(1 - {risk})))) END AS chance
  FROM t),
h AS (SELECT *, chance <= {error} / (count(*) OVER () - row_number() OVER (ORDER BY chance, stratum) + 1) AS fine FROM p),
z AS (
  SELECT stratum, rule, cutoff FROM (SELECT *, bool_and(fine) OVER (ORDER BY chance, stratum) AS allowed FROM h)
  JOIN q USING (stratum) WHERE allowed),
b AS (
  SELECT m.r, string_agg(z.rule, ',' ORDER BY place) AS broken FROM m JOIN z USING (stratum)
  JOIN v ON v.r = m.r AND v.rule = z.rule AND v.value > z.cutoff
  JOIN (SELECT DISTINCT place, rule FROM c) o ON o.rule = z.rule GROUP BY m.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND broken IS NULL AS kept, stratum, coalesce(broken, '') AS broken
FROM m LEFT JOIN b ON m.r = b.r"""


ORACLES["op2_quality_rules"] = _quality_sql()


@query
def op3_balanced_shards(spark, sf):
    return sharding.balanced_shards(table(spark, sf, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# CRC-32 byte by byte: the table of the reflected polynomial comes from its rule.
ORACLES["op3_balanced_shards"] = """
WITH t AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i))),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b
  FROM documents),
k AS (
  SELECT r, doc_id, size, xor(list_reduce(list_prepend(4294967295, b),
    lambda a, x: xor(a >> 8, crc[xor(a, x) % 256 + 1])), 4294967295) AS text_crc32 FROM d, t),
o AS (
  SELECT *, row_number() OVER w AS n, sum(size) OVER w - size AS start, sum(size) OVER () AS total FROM k
  WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size, r ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CAST(start * 8 // total AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY n) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard FROM s"""


@query
def op4_token_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = tokens.with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 1024).alias("over_limit"),
    )


@query
def op5_simhash_near_dedup(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _rotated(x: str, bits: int) -> str:
    """A 64-bit number turned left, in 128-bit arithmetic modulo ``m``."""
    return f"(({x}) * {1 << bits}::UHUGEINT % m + ({x}) * {1 << bits}::UHUGEINT // m)"


def _lane(x: str) -> str:
    return f"({_rotated(f'{x} * p2 % m', 31)} * p1 % m)"


# XXH64 from its published rules; lanes are read from the hexadecimal text of a shingle.
ORACLES["op5_simhash_near_dedup"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+'), []) AS w
  FROM documents),
g AS (
  SELECT r, array_to_string(w[s:s + 2], ' ') AS shingle
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
u AS (SELECT DISTINCT shingle, hex(encode(shingle)) AS h, strlen(shingle) AS n FROM g),
b AS (
  SELECT shingle, n, n // 32 * 4 AS striped, 18446744073709551616::UHUGEINT AS m,
    list_transform(range(n // 8), lambda i: CAST('0x' || array_to_string(list_reverse(
      regexp_extract_all(substr(h, 16 * i + 1, 16), '..')), '') AS UHUGEINT)) AS lanes,
    CASE WHEN n % 8 >= 4 THEN CAST('0x' || array_to_string(list_reverse(
      regexp_extract_all(substr(h, n // 8 * 16 + 1, 8), '..')), '') AS UHUGEINT) END AS half,
    list_transform(regexp_extract_all(substr(h, n // 4 * 8 + 1), '..'), lambda x: CAST('0x' || x AS UHUGEINT)) AS rest,
    11400714785074694791::UHUGEINT AS p1, 14029467366897019727::UHUGEINT AS p2, 1609587929392839161::UHUGEINT AS p3,
    9650029242287828579::UHUGEINT AS p4, 2870177450012600261::UHUGEINT AS p5, 42::UHUGEINT AS seed
  FROM u),
v AS (
  SELECT *, list_transform([seed + p1 + p2, seed + p2, seed, m + seed - p1], lambda start, i: list_reduce(
    list_prepend(start % m, lanes[i:striped:4]), lambda a, x: {_rotated("(a + x * p2 % m) % m", 31)} * p1 % m)) AS acc
  FROM b),
s AS (
  SELECT *, (n::UHUGEINT + CASE WHEN striped = 0 THEN seed + p5 ELSE list_reduce(list_prepend(
      ({_rotated("acc[1]", 1)} + {_rotated("acc[2]", 7)} + {_rotated("acc[3]", 12)} + {_rotated("acc[4]", 18)}) % m, acc),
    lambda a, x: (xor(a, {_lane("x")}) * p1 + p4) % m) END) % m AS h0
  FROM v),
l AS (
  SELECT *, list_reduce(list_prepend(h0, lanes[striped + 1:]),
    lambda a, x: ({_rotated(f"xor(a, {_lane('x')})", 27)} * p1 + p4) % m) AS h1 FROM s),
q AS (
  SELECT *, CASE WHEN half IS NULL THEN h1 ELSE ({_rotated("xor(h1, half * p1 % m)", 23)} * p2 + p3) % m END AS h2 FROM l),
y AS (SELECT *, list_reduce(list_prepend(h2, rest), lambda a, x: {_rotated("xor(a, x * p5 % m)", 11)} * p1 % m) AS h3 FROM q),
z AS (
  SELECT shingle, CAST(xor(h5, h5 // {1 << 32}::UHUGEINT) AS UBIGINT) AS x FROM (
    SELECT *, xor(h4, h4 // {1 << 29}::UHUGEINT) * p3 % m AS h5 FROM (
      SELECT *, xor(h3, h3 // {1 << 33}::UHUGEINT) * p2 % m AS h4 FROM y))),
c AS (
  SELECT r, bit, count(*) AS n, count(*) FILTER (WHERE (x >> bit) & 1::UBIGINT = 1) AS ones
  FROM (SELECT r, x, CAST(unnest(range(64)) AS UBIGINT) AS bit FROM g JOIN z USING (shingle)) GROUP BY r, bit),
f AS (
  SELECT d.r, doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM d LEFT JOIN (
    SELECT r, bit_or(CASE WHEN 2 * ones > n THEN 1::UBIGINT << bit ELSE 0::UBIGINT END) AS fp FROM c GROUP BY r) USING (r)),
e AS (SELECT DISTINCT fp FROM f),
k AS (SELECT a.fp AS a, b.fp AS b FROM e a JOIN e b ON bit_count(xor(a.fp, b.fp)) <= 3),
t AS (SELECT a AS fp, a AS to_fp FROM k UNION SELECT t.fp, k.b FROM t JOIN k ON t.to_fp = k.a)
SELECT doc_id, lower(lpad(hex(fp), 16, '0')) AS fingerprint, component_id
FROM f JOIN (SELECT t.fp, min(f.doc_id) AS component_id FROM t JOIN f ON f.fp = t.to_fp GROUP BY 1) USING (fp)
"""


@query
def op6_recompression_dedup(spark, sf):
    found = recompression.recompression_dedup(table(spark, sf, "documents"), 20)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", _span_list(F.col("spans")).alias("spans"))


ORACLES["op6_recompression_dedup"] = _repeats_sql(20)


@query
def op7_main_text(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", "url", "html")
    found = pages.with_main_text(rows).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))


# The pages of these tables hold one article each, with headings and paragraphs as blocks.
ORACLES["op7_main_text"] = r"""
WITH a AS (
  SELECT page_id, url, unnest(list_transform(string_split_regex(
      regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '</?(?:p|h1|li|ul)(?:\s[^>]*)?>'),
    lambda x, i: {'i': i, 'x': replace(replace(replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')})) AS b
  FROM pages),
t AS (SELECT page_id, url, b.i AS i, trim(regexp_replace(b.x, '\s+', ' ', 'g')) AS block FROM a),
j AS (SELECT page_id, url, string_agg(block, chr(10) || chr(10) ORDER BY i) AS text FROM t WHERE block <> '' GROUP BY 1, 2)
SELECT p.page_id, p.url, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars
FROM pages p LEFT JOIN j ON p.page_id = j.page_id AND p.url = j.url"""


@query
def op8_sampled_pieces(spark, sf):
    return pieces.with_pieces(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


@query
def op9_decontaminate(spark, sf):
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _items_digest(F.col("items")).alias("items_sha256"), "contaminated",
    )


_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op9_decontaminate"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({_FOLDED.format('text')}, '{_ITEM_WORD}'), []) AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all({_FOLDED.format('text')}, '{_ITEM_WORD}') AS w FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, m, w[s:s + m - 1] AS pat
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
    FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT m FROM p),
x AS (
  SELECT r, m, s, w[s:s + m - 1] AS pat
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d JOIN n ON len(w) >= m)),
o AS (SELECT x.r, x.s, x.m, p.item_id FROM x JOIN p ON x.m = p.m AND x.pat = p.pat),
h AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS pos FROM o) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM o WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)"""


@query
def op10_deleted_interpolation(spark, sf):
    return language_model.score_documents(table(spark, sf, "documents"))


@query
def op11_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf, "embeddings"), label=label)


ORACLES["op11_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS alike,
    CAST(list_inner_product(a.q, e.q) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10"""


@query
def op12_token_records(spark, sf):
    tokenizer, path = public_tokenizers.path("byte_bpe_50k.json"), scratch_dir(spark, "token-records")
    index = records.write_records(table(spark, sf, "documents"), path, tokenizer, end_id=2)
    found = records.check_records(index, path, tokenizer)
    # One row for each file.
    return found.join(F.broadcast(records.starts(index)), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


@query
def op13_filter_audit(spark, sf):
    return filter_audit.interactions(table(spark, sf, "documents"), table(spark, sf, "labels"))


ORACLES["op13_filter_audit"] = """
WITH l(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v, w, x, y, z] AS ls FROM l v, l w, l x, l y, l z
  WHERE len(list_distinct([v.c, w.c, x.c, y.c, z.c])) = 5),
s AS (
  SELECT filter_order, step, ls[step].c AS letter, ls[step].b AS bit,
    CAST(coalesce(list_sum(list_transform(ls[:step - 1], lambda x: x.b)), 0) AS INTEGER) AS before
  FROM (SELECT filter_order, ls, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM o)),
d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce(doc_id, 9223372036854775807) AS id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN id > min(id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM d),
k AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN k USING (doc_id) GROUP BY 1, 2),
t AS (
  SELECT part, filter_order, step, letter,
    CAST(coalesce(sum(n) FILTER (WHERE mask & (before | bit) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & before = 0), 0) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM t"""
