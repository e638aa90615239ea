"""Hard negatives: exact inner-product searches by candidate lists that clusters of anchors share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centerline.llm.common import batch_of, mapped, written

SAMPLE = 4096  # queries that clusters are fitted on, at most
CLUSTERS = 64  # clusters, at most; one for each MEMBERS queries while there are fewer
MEMBERS = 128
GROUP = 16384  # queries of a tile, at most on average
BLOCK = 16384  # candidates of a tile, at most on average
SHELLS = 16  # steps of the angle by which a cluster's candidates are parted
SLACK = 1e-7  # of the product of lengths: far above what rounding does to an angle
STEP, SLICE = 512, 1024  # candidates of a list, and members of a group, that are multiplied at a time

_LAST = (1 << 63) - 1  # stands for a null id
_FOUND = "query long, p long, id long, score long"
_WINDOW = "struct<p:bigint,low:bigint,high:bigint,floor:bigint>"
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _same_width(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(one.shape[1], other.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (one, other))


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))


def _angles(matrix: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of vectors and their angles to each centre; a vector of zeros is at a right angle to all."""
    lengths = _lengths(matrix)
    matrix, centres = _same_width(matrix.astype(np.float64), centres)
    units = matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
    return lengths, np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def _centres(sample: np.ndarray, n: int, rounds: int = 10) -> np.ndarray:
    """Unit vectors that the sample's directions gather around: spherical k-means from spread-out members."""
    lengths = _lengths(sample)
    units = sample[lengths > 0] / lengths[lengths > 0][:, None]
    if not len(units):
        return np.zeros((1, sample.shape[1]))
    centres = units[:1]
    nearest = units @ centres[0]
    while len(centres) < min(n, len(units)):
        centres = np.vstack([centres, units[np.argmin(nearest)]])
        nearest = np.maximum(nearest, units @ centres[-1])
    for _ in range(rounds):
        own = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        size = _lengths(sums)
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1.0)[:, None], centres)
    return centres


def _near(centres: np.ndarray):
    """Adds the nearest centre of each query and the angle to it."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, angles = _angles(_matrix(batch.column("q")), centres)
            yield batch_of({
                **{c: batch.column(c) for c in ("query", "label", "q")}, "length": lengths,
                "cluster": np.argmin(angles, axis=1).astype(np.int32), "angle": angles.min(axis=1),
            })

    return near


def _bound(lengths: np.ndarray, angles: np.ndarray, radius: np.ndarray | float) -> np.ndarray:
    """No query of length 1 within ``radius`` of the centre has a larger product with a candidate."""
    return lengths * (np.cos(np.maximum(0.0, angles - radius)) + SLACK)


def _placed(centres: np.ndarray, radius: np.ndarray):
    """Adds the place of each candidate, and its bound for each cluster."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, angles = _angles(_matrix(batch.column("q")), centres)
            near = np.argmin(angles, axis=1)
            bounds = _bound(lengths[:, None], angles, radius[None, :])
            shell = np.minimum(angles.min(axis=1) * (SHELLS / np.pi), SHELLS - 1).astype(np.int64)
            yield batch_of({
                **{c: batch.column(c) for c in ("label", "q", "ids")}, "area": near * SHELLS + shell,
                "bounds": pa.ListArray.from_arrays(
                    pa.array(np.arange(len(near) + 1) * len(radius), pa.int32()), pa.array(bounds.ravel())
                ),
            })

    return placed


def _best(keys: np.ndarray, scores: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each key: larger scores, then smaller ids."""
    order = np.lexsort((least, -scores, keys))
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
    rank = np.arange(len(ranked)) - np.repeat(first, np.diff(np.append(first, len(ranked))))
    return order[rank < k]


def _tile(centres: np.ndarray, k: int, same: bool):
    """All members of a group of queries walk one list of a block's candidates, sorted by their bounds.

    A member stops once the bound of the next candidate is below what it would still take: of its windows, the
    smallest of the lower end and the ``k``-th score found there (in this block, or in one before).
    """

    def walk(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([(c, pa.int64()) for c in ("query", "p", "id", "score")])
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        members, items = _same_width(_matrix(queries.column("q")), _matrix(candidates.column("q")))
        centre = centres[queries.column("cluster")[0].as_py()][None, :]
        lengths, angles = _angles(items, centre)
        bound = _bound(lengths, angles[:, 0], queries.column("angle").to_numpy().max())
        order = np.argsort(-bound, kind="stable")
        bound, items = bound[order], items[order]
        kinds = candidates.column("label").to_numpy()[order]
        ids = candidates.column("ids").combine_chunks().take(pa.array(order))
        least = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]  # smallest first
        own, own_length = queries.column("label").to_numpy(), queries.column("length").to_numpy()
        # Products of whole numbers are exact in doubles up to 2**53.
        exact = np.abs(members).max(initial=0) * 1.0 * np.abs(items).max(initial=0) * max(1, members.shape[1]) < 2.0**53
        if exact:
            members, items = members.astype(np.float64), items.astype(np.float64)
        windows = queries.column("windows").combine_chunks()
        ends = windows.offsets.to_numpy()
        flat = {n: windows.values.field(n).to_numpy(zero_copy_only=False) for n in ("low", "high", "floor")}
        shape = (len(own), int(np.diff(ends).max(initial=0)))
        used = np.arange(shape[1]) < np.diff(ends)[:, None]
        low, high, floor = (np.full(shape, fill, dtype=np.int64) for fill in (_HIGHEST, _LOWEST, _LOWEST))
        for place, name in ((low, "low"), (high, "high"), (floor, "floor")):
            place[used] = flat[name]
        take = np.maximum(low, floor)
        hits = []
        for a in range(0, len(own), SLICE):
            part = slice(a, a + SLICE)
            found = [np.zeros(0, np.int64)] * 3  # key of member and window, candidate, score
            need = take[part].copy()
            for s in range(0, len(items), STEP):
                live = np.flatnonzero(own_length[part] * bound[s] + 1e-6 >= need.min(axis=1))
                if not len(live):
                    break
                scores = (members[part][live] @ items[s:s + STEP].T).astype(np.int64)
                fits = (own[part][live][:, None] == kinds[None, s:s + STEP]) == same
                more = []
                for w in range(shape[1]):
                    mine = np.where(
                        fits & (scores >= need[live, w][:, None]) & (scores <= high[part][live, w][:, None]), scores, _LOWEST
                    )
                    if mine.shape[1] > k:
                        # At least k candidates reach the k-th largest of them.
                        cut = np.partition(mine, mine.shape[1] - k, axis=1)[:, -k]
                        mine = np.where(mine >= cut[:, None], mine, _LOWEST)
                    r, c = np.nonzero(mine > _LOWEST)
                    more.append((live[r] * shape[1] + w, s + c, mine[r, c]))
                found = [np.concatenate([f, *(m[i] for m in more)]) for i, f in enumerate(found)]
                keep = _best(found[0], found[2], least[found[1]], k)
                found = [f[keep] for f in found]
                # A key with k candidates takes no smaller score any more.
                keys, counts = np.unique(found[0], return_counts=True)
                last = np.cumsum(counts) - 1
                full = counts == k
                at = keys[full]
                need[at // shape[1], at % shape[1]] = np.maximum(need[at // shape[1], at % shape[1]], found[2][last[full]])
            hits.append((found[0] + a * shape[1], found[1], found[2]))
        key, item, score = (np.concatenate([h[i] for h in hits]) for i in range(3))
        repeats = ids.value_lengths().to_numpy()[item]
        every = ids.take(pa.array(item)).flatten().to_numpy()
        key, score = np.repeat(key, repeats), np.repeat(score, repeats)
        keep = _best(key, score, every, k)
        key, score, every = key[keep], score[keep], every[keep]
        p = windows.values.field("p").take(pa.array(ends[key // max(1, shape[1])] + key % max(1, shape[1])))
        return pa.table({
            "query": queries.column("query").combine_chunks().take(pa.array(key // max(1, shape[1]))), "p": p,
            "id": pa.array(every, pa.int64()), "score": pa.array(score, pa.int64()),
        })

    return walk


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query and window, as one sorted array of ``by, id`` with ``by`` the score times -1."""
    order = Window.partitionBy("query", "p").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    pair = F.struct((-F.col("score")).alias("by"), F.col("id"))
    return ranked.groupBy("query", "p").agg(F.array_sort(F.collect_list(pair)).alias("found"))


def _search(queries: DataFrame, candidates: DataFrame, visits: DataFrame, centres: np.ndarray, k: int, same: bool) -> DataFrame:
    """``query, p, found``: the first ``k`` candidates of each query's windows.

    Each group of queries first walks the block with the highest bound. What it finds there is a floor for all its
    other walks, and blocks whose bound is below the floors of all members are not visited.
    """

    def walked(tiles: DataFrame, asking: DataFrame) -> DataFrame:
        left = asking.join(tiles, "grp").groupBy("grp", "block")
        right = candidates.join(tiles, "block").groupBy("grp", "block")
        return written(left.cogroup(right).applyInArrow(_tile(centres, k, same), _FOUND), "negatives-found")

    best = Window.partitionBy("grp").orderBy(F.desc("bound"), "block")
    ranked = written(visits.withColumn("n", F.row_number().over(best)), "negatives-visits")
    first = walked(ranked.where("n = 1").select("grp", "block"), queries)
    floors = _first(first, k).select(
        "query", "p", F.when(F.size("found") >= k, -F.element_at("found", -1)["by"]).alias("reached")
    )
    asked = queries.select("*", F.explode("windows").alias("w")).join(
        floors.withColumnRenamed("query", "q2"), (F.col("query") == F.col("q2")) & F.col("w.p").eqNullSafe(F.col("p")), "left"
    )
    floor = F.greatest(F.col("w.floor"), F.coalesce("reached", F.lit(_LOWEST)))
    window = F.struct("w.p", "w.low", "w.high", floor.alias("floor"))
    raised = asked.groupBy("query").agg(F.collect_list(window).alias("windows"))
    again = written(queries.drop("windows").join(raised, "query"), "negatives-asking")
    needs = again.select("grp", "length", F.explode("windows").alias("w")).groupBy("grp").agg(
        F.max("length").alias("longest"), F.min("length").alias("shortest"),
        F.min(F.greatest("w.low", "w.floor")).alias("need"),
    )
    reach = F.greatest(F.col("bound") * F.col("longest"), F.col("bound") * F.col("shortest")) + 1e-6
    rest = ranked.where("n > 1").join(needs, "grp").where(reach >= F.col("need")).select("grp", "block")
    return _first(first.unionAll(walked(rest, again)), k)


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def hard_negatives(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    anchor: Column | None = None, scale: float = 256.0, positives: int = 5, negatives: int = 10,
    low: tuple[int, int] = (30, 100), high: tuple[int, int] = (90, 100),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, and a row's score is its inner product with an anchor. An anchor's
    positives are its first ``positives`` other rows of the same label; for each, the first ``negatives`` rows of
    other labels with a score between the shares ``low`` and ``high`` of the positive's are returned. Larger scores
    come first, then smaller ids. ``anchor`` (default: ids divisible by 100) says which rows are anchors.

    Anchors with one label and vector are one query. Queries are parted by the nearest of at most ``CLUSTERS``
    directions, fitted on at most ``SAMPLE`` of them. A candidate's score is at most the product of the lengths and
    the cosine of its angle to the direction less the largest angle of the cluster's queries: each block of
    candidates is sorted by that once for a cluster, and every query walks the list until no later row can matter.
    Results are exact whatever the clusters are. Queries meet candidates in tiles of bounded size; tiles that no
    query can gain from are left out. Of rows with one label and vector only so many of the smallest ids as may be
    returned are candidates, so a vector that very many rows share costs a few.

    Rows with a null label or vector or with a component that is null or not finite take no part. Null ids are no
    anchors and come after all others, and are returned as null. Rows that repeat id, label and vector are one.
    Shorter vectors are taken as filled up with zeros. Scores have to fit 55 bits. An empty table gives no rows.
    """
    name = F.col(label) if isinstance(label, str) else label
    is_anchor = F.col(vec_id) % 100 == 0 if anchor is None else anchor
    x = F.col(vector)
    grid = F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale))).cast("long"))
    table = written(rows.where(finite(x)).select(
        F.coalesce(F.col(vec_id).cast("long"), F.lit(_LAST)).alias("id"), name.cast("long").alias("label"), grid.alias("q"),
        F.coalesce(is_anchor & F.col(vec_id).isNotNull(), F.lit(False)).alias("anchor"),
    ).where("label IS NOT NULL").dropDuplicates(["id", "label", "q"]), "negatives-rows")

    anchors = table.where("anchor")
    queries = written(
        anchors.groupBy("label", "q").agg(F.count("*").alias("n")).select(
            F.monotonically_increasing_id().alias("query"), "label", "q"
        ), "negatives-queries",
    )
    sample = queries.orderBy(F.xxhash64("label", "q"), "query").limit(SAMPLE).select("q").collect()
    count = queries.count()
    width = max((len(r.q) for r in sample), default=0)
    known = np.array([list(r.q) + [0] * (width - len(r.q)) for r in sample], dtype=np.float64).reshape(len(sample), width)
    centres = _centres(known, max(1, min(CLUSTERS, count // MEMBERS))) if len(sample) else np.zeros((1, 0))
    schema = "query long, label long, q array<long>, length double, cluster int, angle double"
    near = written(mapped(queries, _near(centres), schema), "negatives-near")
    radii = {r.cluster: r.angle for r in near.groupBy("cluster").agg(F.max("angle").alias("angle")).collect()}
    radius = np.array([radii.get(c, 0.0) for c in range(len(centres))])

    kept = max(positives + 1, negatives)
    by_id = Window.partitionBy("label", "q").orderBy("id")
    bodies = table.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= kept).groupBy("label", "q").agg(
        F.array_sort(F.collect_list("id")).alias("ids")
    )
    schema = "label long, q array<long>, ids array<long>, area long, bounds array<double>"
    placed = written(mapped(bodies, _placed(centres, radius), schema), "negatives-candidates")
    candidates = _dealt(placed, "area", F.xxhash64("q"), BLOCK, "block")
    bounds = written(candidates.groupBy("block").agg(
        *[F.max(F.get("bounds", F.lit(c))).alias(f"b{c}") for c in range(len(centres))]
    ), "negatives-bounds").select("block", F.posexplode(F.array(*[f"b{c}" for c in range(len(centres))])).alias("cluster", "bound"))
    asking = _dealt(near, "cluster", F.xxhash64("query"), GROUP, "grp")
    visits = asking.select("grp", "cluster").distinct().join(bounds, "cluster").select("grp", "block", "bound")
    candidates = candidates.select("block", "label", "q", "ids")

    every = F.array(F.struct(
        F.lit(None).cast("long").alias("p"), F.lit(_LOWEST + 1).alias("low"), F.lit(_HIGHEST).alias("high"), F.lit(_LOWEST).alias("floor"),
    )).cast(f"array<{_WINDOW}>")
    close = written(_search(
        asking.withColumn("windows", every), candidates, visits, centres, positives + 1, True
    ).select("query", "found"), "negatives-positives")

    # Bounds of the shares in whole numbers: the least at or over the one, the largest at or under the other.
    p = lambda x: -x["by"]

    def share(score: Column, part: tuple[int, int]) -> Column:
        """The part of a score, rounded down."""
        of, over = score * F.lit(part[0]).cast("long"), F.lit(part[1]).cast("long")
        return F.call_function("div", of - F.pmod(of, over), over)

    windows = F.array_distinct(F.transform("found", lambda x: F.struct(
        p(x).alias("p"), (-share(x["by"], low)).alias("low"), share(p(x), high).alias("high"),
        F.lit(_LOWEST).alias("floor"),
    ))).cast(f"array<{_WINDOW}>")
    wanted = F.filter(windows, lambda w: w["low"] <= w["high"])
    asked = asking.join(close.select("query", wanted.alias("windows")), "query").where("size(windows) > 0")
    far = _search(asked, candidates, visits, centres, negatives, False)

    own = anchors.join(queries, ["label", "q"]).select("id", "query").join(close, "query").select(
        "id", "query", F.explode(F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, positives)).alias("x")
    ).select("query", F.col("id").alias("anchor"), F.col("x.id").alias("positive"), (-F.col("x.by")).alias("p"))
    pairs = own.join(far, ["query", "p"]).select("anchor", "positive", "p", F.posexplode("found").alias("n", "x"))
    true_id = lambda c: F.nullif(F.col(c), F.lit(_LAST))
    return pairs.select(
        F.col("anchor").alias("anchor_id"), true_id("positive").alias("positive_id"), (F.col("n") + 1).cast("int").alias("rank"),
        true_id("x.id").alias("negative_id"), F.col("p").alias("positive_score"), (-F.col("x.by")).alias("negative_score"),
    )


def _dealt(rows: DataFrame, by: str, key: Column, size: int, name: str) -> DataFrame:
    """Number parts of about ``size`` rows that have one value of ``by``; equal keys fall into one part."""
    parts = rows.groupBy(F.col(by).alias("of")).agg(F.ceil(F.count("*") / size).alias("parts"))
    number = F.col(by).cast("long") * (1 << 40) + F.pmod(key, F.col("parts"))
    return rows.join(F.broadcast(parts), F.col(by) == F.col("of")).withColumn(name, number).drop("of", "parts")
