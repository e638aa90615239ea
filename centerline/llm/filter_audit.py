"""What each filter of a cascade removes, alone and behind the others, in every order."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centerline.llm.common import written

FILTERS = "ABCDE"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_CAPITALS = "".join(map(chr, range(65, 91)))


def text_failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A 1, B 2, C 4, D 8."""
    # A text that begins or ends with white space gives an empty part there.
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    failed = (
        n < 100, kinds.cast("long") * 100 < n.cast("long") * 80,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 10, text.rlike(r"[#$%&*|]"),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))


def failure_cells(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """``part, mask, n, good, toxic``: how many documents of each part fail exactly the filters of a mask.

    Texts are read once, for the flags of A to D and a SHA-256; what moves from there on is one narrow row for each
    document. E falls on every document but those with the smallest id of its text. That id is the minimum of an
    aggregation by text, and it meets the documents by text and id together, so copies of one text spread over all
    partitions. Labels are put together by id first: one of quality 1 or toxic 1 is enough.
    """
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = written(docs.select(
        order.alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        text_failures(body).alias("mask"), F.unhex(F.sha2(body, 256)).alias("text"), F.col(doc_id).isNotNull().alias("known"),
    ), "audit-flags")
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    ).withColumn("known", F.lit(True))
    least = rows.groupBy("text").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    flagged = rows.join(least, ["text", "id"], "left").join(marks, ["id", "known"], "left")
    mask = F.col("mask") + F.when(F.col("first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    return flagged.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"),
    )


def _entry(**values: Column) -> Column:
    return F.struct(*[values[c].cast("long").alias(c) for c in COUNTS])


def _folded(orders: Column) -> Column:
    """The entries of one mask: for each order and step what the cell adds, orders one after the other.

    A fold over the steps of an order carries whether a filter has removed the cell, and the entries so far.
    """
    mask, n, good, toxic = (F.col(c).cast("long") for c in ("mask", "n", "good", "toxic"))
    nothing = F.lit(0)
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(len(FILTERS))])

    def step(state: Column, letter: Column) -> Column:
        gone, bit = state["gone"], F.get(bits, F.instr(F.lit(FILTERS), letter) - 1)
        fails = mask.bitwiseAND(bit) != 0
        now = fails & ~gone
        entry = _entry(
            kept=F.when(gone | fails, nothing).otherwise(n), removed=F.when(now, n).otherwise(nothing),
            redundant=F.when(fails & gone, n).otherwise(nothing), unique_fails=F.when(mask == bit, n).otherwise(nothing),
            good_lost=F.when(now, good).otherwise(nothing), toxic_lost=F.when(now, toxic).otherwise(nothing),
        )
        return F.struct((gone | fails).alias("gone"), F.concat(state["entries"], F.array(entry)).alias("entries"))

    empty = F.expr(f"cast(array() AS array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>)")
    start = F.struct(F.lit(False).alias("gone"), empty.alias("entries"))
    return F.flatten(F.transform(
        orders, lambda order: F.aggregate(F.split(order, ""), start, step, lambda state: state["entries"])
    ))


def audit(cells: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: ``part, filter_order, step``, the counts, ``shapley``.

    ``cells`` is what ``failure_cells`` returns. The orders are a constant array that goes to the tasks with the plan:
    120 orders of 5 steps. Each cell folds over it to 600 entries, weighted by its counts; the entries of a part, of
    at most 32 cells, are added up place by place. ``shapley`` adds up what the step's filter removes over all orders,
    at whatever step. A part without documents has no rows; counts of 0 stay.
    """
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    entries = cells.select("part", F.posexplode(_folded(orders)).alias("place", "e"))
    merged = entries.groupBy("part", "place").agg(*[F.sum(f"e.{c}").alias(c) for c in COUNTS])
    order = F.get(orders, F.floor(F.col("place") / 5).cast("int"))
    step = F.col("place") % 5 + 1
    at = merged.select("part", order.alias("filter_order"), step.cast("int").alias("step"), *COUNTS)
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return at.withColumn("shapley", F.sum("removed").over(own))


def interactions(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """The audit of filters A to E over whole documents.

    A fails texts of under 100 words, B those with under 80 different words in 100 (case-sensitive), C those with more
    than 10 capitals A-Z in 100 characters, D those with one of ``#$%&*|``, and E those equal to the text of a smaller
    id anywhere in the table. Null texts are empty, null parts are the part ``''``, null ids count as larger than all
    others and have no labels. Rows that repeat the smallest id of a text pass E together. Labels with null ids are
    left out. Other columns are not read; an empty table gives no rows.
    """
    return audit(failure_cells(docs, labels, doc_id, text, part))
