"""Scores of texts under an n-gram model learned from the corpus by deleted interpolation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import WordHashes, batch_of, in_blocks, mapped, mix, partitions, texts_of, written

U = np.uint64
# Tokens that are no words: the end of a text, and what stands before its first token.
END, BEGIN = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
_PAIR = U(0x9E3779B97F4A7C15)
# Context counts fall into buckets by their number of binary digits.
BUCKETS = 65

_CHUNK = "chunk long, held boolean, payload binary"
_PART = "chunk long, bucket long, keys binary, counts binary"
_ANSWER = "chunk long, bucket long, counts binary, tokens long, kinds long"


def _zstd(data: bytes) -> bytes:
    codec = pa.Codec("zstd")
    return len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True)


def _unzstd(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers with their first bytes together, then their second bytes, and so on; small numbers shrink."""
    return _zstd(np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes())


def _numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unzstd(data), np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _chunks(size: int):
    """Put texts together to chunks of about ``size`` bytes, one row each; held-out texts have chunks of their own."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        bytes_of = {False: 0, True: 0}

        def row(held: bool) -> pa.RecordBatch:
            nonlocal number
            table = pa.Table.from_batches(waiting[held])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            number, waiting[held], bytes_of[held] = number + 1, [], 0
            return batch_of({
                "chunk": pa.array([number], pa.int64()), "held": pa.array([held]),
                "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            })

        for batch in in_blocks(batches, "text", size):
            for held in (False, True):
                mask = pa.compute.equal(batch.column("held"), held)
                part = batch.filter(mask).select(["doc_id", "text"])
                if part.num_rows:
                    n = int(pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0)
                    if waiting[held] and bytes_of[held] + n > size:
                        yield row(held)
                    waiting[held].append(part)
                    bytes_of[held] += n
        for held in (False, True):
            if waiting[held]:
                yield row(held)

    return chunks


class Tokens:
    """The tokens of a chunk: words and an end for each text, their contexts, and which of them are alike."""

    def __init__(self, payload: bytes, hashes: WordHashes):
        table = pa.ipc.open_stream(payload).read_all().combine_chunks()
        self.doc_id = table.column("doc_id").combine_chunks()
        words = [(t or b"").lower().split() for t in texts_of(table.column("text"))]
        self.sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(self.sizes)
        token = np.empty(int(ends[-1]), dtype=np.uint64)
        is_word = np.ones(len(token), dtype=bool)
        is_word[ends - 1] = False
        token[is_word] = hashes.of([w for own in words for w in own])[0]
        token[~is_word] = END
        context = np.concatenate(([BEGIN], token[:-1]))
        context[ends - self.sizes] = BEGIN
        self.token, self.first = token, ends - self.sizes
        self.kinds, self.kind, self.kind_counts = np.unique(mix(token), return_inverse=True, return_counts=True)
        self.end_kind = int(np.searchsorted(self.kinds, mix(np.array([END]))[0]))
        self.pairs, self.pair, self.pair_counts = np.unique(
            mix(mix(context) * _PAIR + token), return_inverse=True, return_counts=True
        )


def _cuts(keys: np.ndarray, buckets: int) -> tuple[list[int], list[int]]:
    """Buckets that sorted keys fall into, and where each begins; keys are spread evenly over 64 bits."""
    bucket = (keys >> U(32)) * U(buckets) >> U(32)
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return bucket[at].tolist(), [*at.tolist(), len(keys)]


def _asked(buckets: int):
    """The different tokens and pairs of each chunk, with how often it has them for training, dealt out by key."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(300_000)
        for batch in batches:
            for chunk, held, payload in zip(*(batch.column(x).to_pylist() for x in ("chunk", "held", "payload"))):
                tokens = Tokens(payload, hashes)
                for order, keys, counts in ((0, tokens.kinds, tokens.kind_counts), (1, tokens.pairs, tokens.pair_counts)):
                    counts = np.zeros_like(counts) if held else counts
                    found, cuts = _cuts(keys, buckets)
                    spans = list(zip(cuts, cuts[1:]))
                    yield batch_of({
                        "chunk": pa.array([chunk] * len(found), pa.int64()),
                        "bucket": pa.array([order * buckets + b for b in found], pa.int64()),
                        "keys": pa.array([_planes(np.diff(keys[a:z], prepend=U(0))) for a, z in spans], pa.binary()),
                        "counts": pa.array([_planes(counts[a:z]) for a, z in spans], pa.binary()),
                    })

    return asked


def _answer(buckets: int):
    """Sum the counts of a bucket's keys over all chunks, and tell each chunk those of its own, in its order."""

    def answer(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        chunks = rows.column("chunk").to_pylist()
        keys = [np.cumsum(_numbers(x), dtype=np.uint64) for x in rows.column("keys").to_pylist()]
        counts = [_numbers(x) for x in rows.column("counts").to_pylist()]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(counts).astype(np.float64)).astype(np.uint64)
        cuts = np.cumsum([0, *map(len, keys)])
        single = bucket < buckets
        # The last row has no chunk: it carries the bucket's part of the sums over all training tokens.
        return pa.table({
            "chunk": pa.array([*chunks, None], pa.int64()), "bucket": pa.array([bucket] * (len(chunks) + 1), pa.int64()),
            "counts": pa.array([*(_planes(total[which[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])), None], pa.binary()),
            "tokens": pa.array([None] * len(chunks) + [int(total.sum()) if single else 0], pa.int64()),
            "kinds": pa.array([None] * len(chunks) + [int((total > 0).sum()) if single else 0], pa.int64()),
        })

    return answer


def _counted(rows: pa.Table, buckets: int, hashes: WordHashes):
    """A chunk's tokens with the corpus counts of each token, of each context, and of each pair."""
    by = sorted(zip(*(rows.column(x).to_pylist() for x in ("bucket", "counts", "payload"))), key=lambda r: r[0])
    tokens = Tokens(by[0][2], hashes)
    single = np.concatenate([_numbers(c) for b, c, _ in by if 0 <= b < buckets])
    double = np.concatenate([_numbers(c) for b, c, _ in by if b >= buckets])
    token = single[tokens.kind]
    context = np.concatenate((token[:1], token[:-1]))
    context[tokens.first] = single[tokens.end_kind]  # a text begins as often as one ends
    return tokens, token, context, double[tokens.pair]


def _bucket_of(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1).astype(np.float64))).astype(np.int64) + 1, 0)


# Estimates that weights are learned from are rounded to this many steps of a halving.
STEPS = 16

_DELETED = "bucket int, double int, single int, n long"


def _step(estimate: np.ndarray) -> np.ndarray:
    """0 for an estimate of 0, else 1 and the number of steps it is below 1."""
    return np.where(estimate > 0, 1 + np.rint(-np.log2(np.where(estimate > 0, estimate, 1.0)) * STEPS), 0).astype(np.int64)


def _deleted(buckets: int, total: int):
    """The different outcomes among training tokens, each with its number; counts are less those of the token's text.

    An outcome is the bucket of the context and the rounded pair and single estimates, so there are few.
    """

    def own(doc: np.ndarray, kind: np.ndarray) -> np.ndarray:
        _, at, n = np.unique(doc * (int(kind.max()) + 1) + kind, return_inverse=True, return_counts=True)
        return n[at]

    def outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, *counts = _counted(pa.Table.from_batches(list(batches)), buckets, WordHashes())
        ends = np.append(tokens.first[1:], tokens.sizes.sum())
        # Whole texts of about 2**17 tokens at a time: a longer text is alone.
        texts = np.flatnonzero(np.diff(ends >> 17, prepend=-1, append=1 << 46))
        for i, j in zip(texts[:-1], texts[1:]):
            a, z = int(tokens.first[i]), int(ends[j - 1])
            doc = np.repeat(np.arange(i, j), tokens.sizes[i:j])
            token, context, pair = (x[a:z].astype(np.int64) for x in counts)
            own_token = own(doc, tokens.kind[a:z])
            own_context = np.concatenate(([1], own_token[:-1]))
            own_context[tokens.first[i:j] - a] = 1  # each text begins once
            pair, context, token = pair - own(doc, tokens.pair[a:z]), context - own_context, token - own_token
            rest = np.maximum(total - tokens.sizes[doc], 1)
            key = (_bucket_of(context) << 32) + (_step(pair / np.maximum(context, 1)) << 16) + _step(token / rest)
            key, n = np.unique(key, return_counts=True)
            yield batch_of({
                "bucket": pa.array(key >> 32, pa.int32()), "double": pa.array(key >> 16 & 0xFFFF, pa.int32()),
                "single": pa.array(key & 0xFFFF, pa.int32()), "n": pa.array(n, pa.int64()),
            })

    return outcomes


def learn_weights(outcomes: DataFrame, kinds: int, rounds: int = 20, enough: float = 1e-3) -> np.ndarray:
    """Weights of the pair, single and uniform estimates for each bucket of context counts, by expectation-maximisation.

    ``outcomes`` has the different outcomes (``bucket, double, single``) and their numbers. Each round is one
    aggregation to a row per bucket. One token is added to each part of a mixture, so that no weight is 0; buckets
    without outcomes keep equal weights. Ends after ``rounds`` rounds or when no weight moves by ``enough``.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    estimates = (
        *(F.when(F.col(c) > 0, F.pow(F.lit(2.0), (1 - F.col(c)) / STEPS)).otherwise(0.0) for c in ("double", "single")),
        F.lit(1.0 / (kinds + 1)),
    )
    for _ in range(rounds):
        # An array of weights, indexed by the bucket.
        parts = [
            F.array(*[F.lit(float(w)) for w in weights[:, i]])[F.col("bucket")] * estimates[i] for i in range(3)
        ]
        rows = outcomes.select("bucket", "n", *[p.alias(f"p{i}") for i, p in enumerate(parts)]).groupBy("bucket").agg(*[
            F.sum(F.col("n") * F.col(f"p{i}") / (F.col("p0") + F.col("p1") + F.col("p2"))).alias(f"n{i}") for i in range(3)
        ]).collect()
        new = np.full((BUCKETS, 3), 1 / 3)
        for r in rows:
            part = np.array([r["n0"], r["n1"], r["n2"]]) + 1.0
            new[r["bucket"]] = part / part.sum()
        moved = np.abs(new - weights).max()
        weights = new
        if moved < enough:
            break
    return weights


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scores(buckets: int, weights: np.ndarray, n: int, kinds: int):
    def scored(rows: pa.Table) -> pa.Table:
        tokens, token, context, pair = _counted(rows, buckets, WordHashes())
        held = next(x for x in rows.column("held").to_pylist() if x is not None)
        own = weights[_bucket_of(context)]
        single = token.astype(np.float64)
        chance = (
            own[:, 0] * pair / np.maximum(context, 1).astype(np.float64) + own[:, 1] * single / max(n, 1)
            + own[:, 2] / (kinds + 1)
        )
        base = np.log10((single + 1) / (n + kinds + 1))
        at = tokens.first
        return pa.table({
            "doc_id": tokens.doc_id, "held_out": pa.array([held] * len(at), pa.bool_()),
            "n_tokens": pa.array(tokens.sizes), "n_known": pa.array(np.add.reduceat((token > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(at), n, dtype=np.int64)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(np.log10(chance), at)),
        })

    return scored


def is_held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is held out: by the checksum of its id as text. Rows without id are not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: Column | None = None,
    chunk_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words of a text with A-Z in lower case, then an end. Documents that are not held out are counted,
    and all are scored. The weights of the mixture are learned from the counted documents too, each token under the
    counts less those of its own document (its estimates rounded to a sixteenth of a halving), and held-out documents
    change nothing but their own rows. ``base_score`` is the add-one unigram score, ``score`` the log10 probability
    under

        w2(b) c(context, token) / c(context) + w1(b) c(token) / N + w0(b) / (V + 1)

    with ``b`` the bucket of the context's count; the context is the token before, or the beginning of the text.

    Texts are put together to chunks of ``chunk_bytes``. A chunk asks for its different tokens and pairs once: packed,
    in key order, dealt out to so many buckets that each holds about two chunks' worth. A bucket sums up and answers
    in the same order. So what moves is one packed entry for each different pair of a chunk; a frequent pair costs
    one per chunk, and no table of counts is ever in one place.

    A null or empty text is an end alone; null ids count for training; repeated rows count each; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    held = is_held_out(F.col(doc_id)) if held_out is None else held_out
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held.alias("held"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    chunks = written(mapped(rows, _chunks(chunk_bytes), _CHUNK), "lm-chunks")
    buckets = max(partitions(spark), chunks.count() // 2) // 2 + 1
    asked = mapped(chunks, _asked(buckets), _PART)
    answers = written(asked.groupBy("bucket").applyInArrow(_answer(buckets), _ANSWER), "lm-counts")
    n, kinds = (int(x or 0) for x in answers.where("chunk IS NULL").agg(F.sum("tokens"), F.sum("kinds")).first())
    both = chunks.select(
        "chunk", F.lit(-1).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("counts"), "payload", "held"
    ).unionAll(answers.where("chunk IS NOT NULL").select(
        "chunk", "bucket", "counts", F.lit(None).cast("binary").alias("payload"), F.lit(None).cast("boolean").alias("held")
    ))
    learned = chunks.where(~F.col("held")).select("chunk")
    outcomes = both.join(learned, "chunk", "left_semi").groupBy("chunk").applyInArrow(_deleted(buckets, n), _DELETED)
    few = outcomes.groupBy("bucket", "double", "single").agg(F.sum("n").alias("n"))
    weights = learn_weights(written(few, "lm-outcomes"), kinds)
    return both.groupBy("chunk").applyInArrow(_scores(buckets, weights, n, kinds), _SCORED)
