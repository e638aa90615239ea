"""Near-duplicates by 64-bit fingerprints of word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import texts_of, written
from centerline.llm.components import components

BITS, HALF = 64, 32


def _fingerprint(text: bytes | None, size: int, digest) -> int:
    """Bits set in over half of the hashes of the text's shingles of ``size`` words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    stops = ends[size - 1:] if len(words) >= size else ends[-1:]
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), stops.tolist())), np.uint64, n
    )
    # Bytes from the lowest on, bits within a byte from the lowest on; blocks bound the memory of long texts.
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, size: int = 3) -> Column:
    """The fingerprint of a text as a signed 64-bit number; 0 for a null text and one without words.

    A-Z become a-z, words are parted by ASCII white space, and shingles are ``size`` words joined by a space, repeats
    included; a text of fewer words is one shingle. Hashes are XXH64 with seed 42.
    """

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        import xxhash

        found = [_fingerprint(t, size, xxhash.xxh64_intdigest) for t in texts_of(texts)]
        return pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    # Never null, and known not to be: else a join by it would test that with a computation of its own.
    return F.coalesce(fingerprint(text.cast("string")), F.lit(0).cast("long"))


def links(marks: DataFrame, within: int = 3) -> DataFrame:
    """Pairs ``u < v`` of different fingerprints in ``marks.fp`` that differ in at most ``within`` bits.

    A fingerprint is cut into two halves. If two differ in at most three bits, one half differs in at most one. So
    each half is indexed once as it is and once for each of its 32 bits with that bit wiped out (a deletion variant).
    Fingerprints with an equal key are joined and compared in full. Under a wiped bit only those with 0 there meet
    those with 1, so a pair meets at most once per half. The caller passes distinct fingerprints: copies never meet,
    and how many different fingerprints share 31 bits is bounded by the other half.
    """
    if not 0 <= within <= 3:
        raise ValueError("two halves with one wiped bit find differences of up to three bits")
    fp = F.col("fp")
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.shiftrightunsigned(fp, HALF).alias("value")),
        F.struct(F.lit(1).alias("half"), fp.bitwiseAND(F.lit((1 << HALF) - 1)).alias("value")),
    )
    cut = marks.select("fp", F.explode(halves).alias("h")).select("fp", "h.half", "h.value")
    bit = F.expr("shiftleft(1L, wiped)")
    variants = cut.select(
        "fp", "half", "value", F.explode(F.sequence(F.lit(-1), F.lit(HALF - 1))).alias("wiped")
    ).select(
        "fp",
        F.when(F.col("wiped") < 0, F.col("value")).otherwise(F.col("value").bitwiseAND(F.bitwise_not(bit))).alias("rest"),
        (F.col("half") * 64 + F.col("wiped") + 1).cast("byte").alias("slot"),
        F.when(F.col("wiped") >= 0, F.col("value").bitwiseAND(bit) != 0).alias("one"),
    )
    left = variants.select("rest", "slot", F.col("fp").alias("a"), F.col("one").alias("a_one"))
    right = variants.select("rest", "slot", F.col("fp").alias("b"), F.col("one").alias("b_one"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= within
    meet = F.when(F.col("a_one").isNull(), F.col("a") < F.col("b")).otherwise(~F.col("a_one") & F.col("b_one"))
    # Spark takes the size of the table before it is multiplied by the variants, and might broadcast it.
    return left.hint("merge").join(right, ["rest", "slot"]).where(meet & near).select(
        F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, within: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``.

    Documents are linked if their fingerprints differ in at most ``within`` bits; ``component_id`` is the smallest id
    that links lead to, the document's own included. Documents with one fingerprint are one node of the graph, so
    copies cost one row each. Null texts and texts without words have fingerprint 0 and are linked like any others; a
    null id is returned as it is and is nobody's ``component_id`` unless all ids of its component are null.
    """
    marked = written(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), fingerprints(F.col(text), size).alias("fp")
    ), "fingerprints")
    return marked.join(classes(marked, within), "fp").select("doc_id", "fp", "component_id")


def classes(marked: DataFrame, within: int = 3) -> DataFrame:
    """``fp, component, component_id`` for every fingerprint of ``marked`` (``doc_id, fp``).

    ``component`` is the smallest fingerprint and ``component_id`` the smallest id of the component.
    """
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = components(links(nodes.select("fp"), within))
    at = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = at.groupBy("component").agg(F.min("least").alias("component_id"))
    return written(at.join(smallest, "component").select("fp", "component", "component_id"), "classes")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, within: int = 3) -> DataFrame:
    """One document of each component, with all its columns and unchanged: the one with the smallest id.

    Of rows that repeat that id in a component one stays. Null ids count as larger than all others.
    """
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(F.struct("*").alias("doc"), order.alias("doc_id"), fingerprints(F.col(text), size).alias("fp"))
    marked = written(rows.select("doc_id", "fp"), "fingerprints")
    first = classes(marked, within)
    kept = rows.join(first, "fp").where("doc_id = component_id")
    return kept.dropDuplicates(["component"]).select("doc.*")
