import random

from centerline.operators import manifest
from centerline.plans import schemas
from centerline.streaming import manifest_stream
from test_manifest import random_history


def rows(frame):
    return sorted(str(sorted(r.asDict().items())) for r in frame.collect())


def test_stream_equals_batch(spark, tmp_path):
    _, marks, calls = random_history(11, 300)
    rng = random.Random(5)
    sources = {"marks": (marks, schemas.MARK_EVENTS), "calls": (calls, schemas.DISCOVER_CALLS)}
    for name, (events, schema) in sources.items():
        at = 0
        while at < len(events):  # batches of random length, in arrival order
            size = rng.randrange(1, 120)
            chunk = spark.createDataFrame(events[at:at + size], schema).coalesce(1)
            chunk.write.mode("append").parquet(str(tmp_path / name))
            at += size
    root = str(tmp_path / "state")
    batch = {
        "files": ("marks", manifest.fold_files), "url_lists": ("marks", manifest.fold_url_lists),
        "discovered_urls": ("calls", manifest.fold_discovered), "mark_counters": ("marks", manifest.count_marks),
        "called_urls": ("calls", manifest.fold_calls),
    }
    for view, (name, fold) in batch.items():
        events, schema = sources[name]
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
        manifest_stream.start_view(stream, view, root, snapshot_every=3).awaitTermination()
        want = fold(spark.createDataFrame(events, schema))
        now = manifest_stream.current(spark, view, root)
        assert now.columns == want.columns
        assert rows(now) == rows(want)

    # More events go on where the stream stopped; an old event lands in its place.
    late = [(10_000, 1.0, "completed", "u0", "p0", "01", 5, None, None),
            (-1, 0.0, "failed", "u0", "p0", "01", None, None, "very old")]
    spark.createDataFrame(late, schemas.MARK_EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "marks"))
    stream = spark.readStream.schema(schemas.MARK_EVENTS).parquet(str(tmp_path / "marks"))
    manifest_stream.start_view(stream, "files", root).awaitTermination()
    want = rows(manifest.fold_files(spark.createDataFrame(marks + late, schemas.MARK_EVENTS)))
    assert rows(manifest_stream.current(spark, "files", root)) == want

    # The states of the stream are its counters and the calls.
    states = manifest_stream.states(spark, root)
    both = manifest.fold_states(
        spark.createDataFrame(marks, schemas.MARK_EVENTS), spark.createDataFrame(calls, schemas.DISCOVER_CALLS)
    )
    assert rows(states) == rows(both)


def test_many_batches_and_repeated_ones_give_one_table(spark, tmp_path):
    rng = random.Random(3)
    root, want = str(tmp_path), {}
    schema = "url string, list_type string, added_at double"
    batches = []
    for n in range(200):
        keys = {rng.choice([None, *(f"u{k}" for k in range(12))]) for _ in range(rng.randint(0, 3))}
        batches.append([(k, rng.choice(["completed", "failed"]), float(n)) for k in keys])

    def put(n):
        manifest_stream.write_batch(spark.createDataFrame(batches[n], schema).coalesce(1), "url_lists", root, n, 8)

    def folders():
        return [sorted(manifest_stream._folders(f"{root}/url_lists/{kind}")) for kind in ("changes", "snapshots")]

    for n, batch in enumerate(batches):
        put(n)
        want.update((r[0], r) for r in batch)
        if n % 40 in (5, 7, 8, 31):
            put(n)  # again, as after a lost driver
            now = manifest_stream.current(spark, "url_lists", root)
            assert sorted(map(str, map(tuple, now.collect()))) == sorted(map(str, want.values()))
            changes, snapshots = folders()
            assert len(changes) <= 16 and len(snapshots) <= 2
            assert len({f.rsplit("/", 2)[1] for f in now.inputFiles()}) <= 9
    # A snapshot whose writing did not end is not read.
    last = max(folders()[1])
    (tmp_path / "url_lists" / "snapshots" / f"upto={last}" / "_SUCCESS").unlink()
    now = manifest_stream.current(spark, "url_lists", root)
    assert sorted(map(str, map(tuple, now.collect()))) == sorted(map(str, want.values()))


def test_state_has_no_more_partitions_than_there_are_cores(spark, tmp_path):
    marks = [(n, float(n), "completed", f"u{n % 7}", f"p{n % 7}", "01", n, None, None) for n in range(40)]
    frame = spark.createDataFrame(marks, schemas.MARK_EVENTS)
    frame.repartition(3).write.parquet(str(tmp_path / "marks"))
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    try:
        for wanted, found in ((None, spark.sparkContext.defaultParallelism), (2, 2)):
            root = str(tmp_path / f"state{wanted}")
            stream = spark.readStream.schema(schemas.MARK_EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "marks"))
            query = manifest_stream.start_view(stream, "files", root, state_partitions=wanted)
            assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
            query.awaitTermination()
            state = tmp_path / f"state{wanted}" / "files" / "checkpoint" / "state" / "0"
            assert len([f for f in state.iterdir() if f.name.isdigit()]) == found
            assert rows(manifest_stream.current(spark, "files", root)) == rows(manifest.fold_files(frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_a_table_that_only_grows_is_not_rewritten_at_every_snapshot(spark, tmp_path):
    root, made = str(tmp_path), set()
    whole = spark.range(0, 48_000, 1, 1).selectExpr("cast(id AS string) AS url", "'failed' AS list_type", "sqrt(id) AS added_at", "id")
    for n in range(16):
        batch = whole.where(f"id div 3000 = {n}").drop("id")
        manifest_stream.write_batch(batch, "url_lists", root, n, 2)
        made |= set(manifest_stream._complete(f"{root}/url_lists/snapshots"))
    assert 3 <= len(made) <= 6
    assert rows(manifest_stream.current(spark, "url_lists", root)) == rows(whole.drop("id"))
