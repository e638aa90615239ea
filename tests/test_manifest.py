import glob
import json
import random

import pytest
from pyspark.sql import functions as F

from centerline.operators import manifest, worklist
from centerline.plans import schemas
from centerline.sources import dims, manifest_json


class Replay:
    """The tracker's rules, one call after the other."""

    def __init__(self):
        self.files, self.lists, self.states, self.known = {}, {}, {}, {}

    def state(self, code, ts):
        return self.states.setdefault(code, {"completed": 0, "failed": 0, "discovered": 0, "at": ts})

    def mark(self, e):
        old = self.files.get(e["path"], {"size": None, "bytes_downloaded": None, "error": None})
        new = {**old, "url": e["url"], "status": e["kind"], "state_fips": e["state_fips"], "timestamp": e["ts"]}
        if e["kind"] == "completed":
            new.update(size=e["size"], bytes_downloaded=None, error=None)
        elif e["kind"] == "failed":
            new.update(error=e["error"])
        else:
            new.update(bytes_downloaded=e["bytes_downloaded"])
        self.files[e["path"]] = new
        if e["kind"] != "partial":
            self.lists[e["url"]] = (e["kind"], e["ts"])
        if e["state_fips"]:
            row = self.state(e["state_fips"], e["ts"])
            if e["kind"] != "partial":
                row[e["kind"]] += 1
                row["at"] = e["ts"]

    def discover(self, code, urls, ts):
        row = self.state(code, ts)
        for url in urls:
            self.known.setdefault((code, url), ts)
        row["discovered"], row["at"] = len(urls), ts


def random_history(seed, n=400):
    rng = random.Random(seed)
    replay, marks, calls = Replay(), [], []
    for seq in range(n):
        state = rng.choice(["01", "02", "03", "", None])
        if rng.random() < 0.1:
            urls = {f"u{rng.randrange(30)}" for _ in range(rng.randrange(5))}
            code = state or "04"
            replay.discover(code, urls, float(seq))
            calls += [(seq, float(seq), code, u) for u in urls] or [(seq, float(seq), code, None)]
            continue
        # A third of the marks are of one file.
        file = 0 if rng.random() < 0.3 else rng.randrange(1, 25)
        event = {
            "seq": seq, "ts": float(seq), "kind": rng.choice(["completed", "failed", "partial"]),
            "url": f"u{file if rng.random() < 0.9 else rng.randrange(30)}", "path": f"p{file}", "state_fips": state,
            "size": rng.choice([None, rng.randrange(100)]), "bytes_downloaded": rng.choice([None, rng.randrange(100)]),
            "error": rng.choice([None, f"e{seq}"]),
        }
        replay.mark(event)
        marks.append(tuple(event.values()))
    rng.shuffle(marks)  # arrival order is free
    return replay, marks, calls


@pytest.fixture(params=[1, 2, 3])
def history(request, spark):
    replay, marks, calls = random_history(request.param)
    return (
        replay,
        spark.createDataFrame(marks, schemas.MARK_EVENTS).repartition(4),
        spark.createDataFrame(calls, schemas.DISCOVER_CALLS),
    )


def by_key(frame, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in frame.collect()}


def test_fold_example(spark):
    rows = [
        (1, 1.0, "completed", "u", "p", "06", 10, None, None), (2, 2.0, "failed", "u", "p", "06", None, None, "e1"),
        (3, 3.0, "partial", "u", "p", "06", None, 5, None), (4, 4.0, "completed", "u", "p", "06", None, None, None),
    ]
    want = [("completed", 10, None, None), ("failed", 10, None, "e1"), ("partial", 10, 5, "e1"), ("completed", None, None, None)]
    for n, expected in enumerate(want, 1):
        marks = spark.createDataFrame(rows[:n], schemas.MARK_EVENTS)
        (row,) = manifest.fold_files(marks).collect()
        assert (row.status, row.size, row.bytes_downloaded, row.error) == expected
    (state,) = manifest.fold_states(marks).collect()
    assert (state.name, state.completed, state.failed, state.discovered) == ("State 06", 2, 1, 0)
    assert manifest.fold_url_lists(marks).first().list_type == "completed"


def test_fold_equals_replay(history):
    replay, marks, calls = history
    files = by_key(manifest.fold_files(marks), "path")
    assert {k[0]: {c: v for c, v in r.items() if c != "path"} for k, r in files.items()} == replay.files
    lists = by_key(manifest.fold_url_lists(marks), "url")
    assert {k[0]: (r["list_type"], r["added_at"]) for k, r in lists.items()} == replay.lists
    states = by_key(manifest.fold_states(marks, calls), "state_fips")
    assert {
        k[0]: {"completed": r["completed"], "failed": r["failed"], "discovered": r["discovered"], "at": r["last_updated"]}
        for k, r in states.items()
    } == replay.states
    known = by_key(manifest.fold_discovered(calls), "state_fips", "url")
    assert {k: r["discovered_at"] for k, r in known.items()} == replay.known


def test_reads_equal_replay(history):
    replay, marks, calls = history
    files, lists = manifest.fold_files(marks), manifest.fold_url_lists(marks)
    states, known = manifest.fold_states(marks, calls), manifest.fold_discovered(calls)
    waiting = manifest.pending(known, lists)
    want = sorted(k for k in replay.known if k[1] not in replay.lists)
    assert sorted(tuple(r) for r in waiting.collect()) == want
    one = manifest.pending(known, lists, ["02"])
    assert sorted(tuple(r) for r in one.collect()) == [k for k in want if k[0] == "02"]

    (total,) = manifest.summary(lists).collect()
    kinds = [k for k, _ in replay.lists.values()]
    assert tuple(total) == (len(kinds), kinds.count("completed"), kinds.count("failed"))

    def urls(state, status):
        return sorted(f["url"] for f in replay.files.values() if f["state_fips"] == state and f["status"] == status)

    progress = by_key(manifest.progress(states, files, waiting, k=2), "state_fips")
    report = manifest.status_report(states, files, waiting, k=3).collect()
    assert [r.state_fips for r in report] == sorted(replay.states)
    for row in report:
        code, seen = row.state_fips, progress[(row.state_fips,)]
        mine = [u for s, u in want if s == code]
        assert row.completed_urls == urls(code, "completed")[:3]
        assert row.failed_urls == urls(code, "failed")[:3]
        assert row.pending_urls == mine[:3]
        assert row.total == replay.states[code]["completed"] + replay.states[code]["failed"]
        assert seen["completed"] == len(urls(code, "completed")) and seen["failed"] == len(urls(code, "failed"))
        assert (seen["pending"], seen["pending_urls"]) == (len(mine), mine[:2])
    assert [r.state_fips for r in manifest.requested_states(states).collect()] == sorted(replay.states)
    assert manifest.state_rows(states, "02").count() == 1

    asked = files.sparkSession.createDataFrame([(p,) for p in [*replay.files, "nowhere"]], "path string")
    for path, done, size in manifest.look_up(files, asked).collect():
        row = replay.files.get(path, {})
        assert done == (row.get("status") == "completed")
        assert size == ((row.get("bytes_downloaded") or 0) if row.get("status") == "partial" else 0)


def test_replace_modes(spark, history):
    _, marks, calls = history
    events = sorted(marks.collect(), key=lambda r: r.seq)
    last = {e.path: e for e in events}
    for r in manifest.fold_files(marks, mode="replace").collect():
        e = last[r.path]
        assert (r.status, r.size, r.bytes_downloaded, r.error) == (
            e.kind, e.size if e.kind == "completed" else None,
            e.bytes_downloaded if e.kind == "partial" else None, e.error if e.kind == "failed" else None,
        )
    newest = {}
    for c in sorted(calls.collect(), key=lambda r: r.seq):
        newest.setdefault(c.state_fips, {}).setdefault(c.seq, set()).add(c.url)
    want = {(s, u) for s, sets in newest.items() for u in sets[max(sets)] if u}
    got = {(r.state_fips, r.url) for r in manifest.fold_discovered(calls, mode="replace").collect()}
    assert got == want


def test_empty_manifest(spark):
    marks = spark.createDataFrame([], schemas.MARK_EVENTS)
    assert manifest.fold_files(marks).count() == 0
    assert tuple(manifest.summary(manifest.fold_url_lists(marks)).first()) == (0, 0, 0)


def test_new_discoveries_and_names(spark):
    known = spark.createDataFrame([("06", "a")], "state_fips string, url string")
    call = spark.createDataFrame(
        [(5, 5.0, "06", "a"), (5, 5.0, "06", "b"), (6, 6.0, "06", "b"), (7, 7.0, "13", None)], schemas.DISCOVER_CALLS
    )
    assert [tuple(r) for r in manifest.new_discoveries(known, call).collect()] == [("06", "b", 5.0)]
    states = spark.createDataFrame([("06", "State 06", 1, 0, 0, 1.0), ("07", "State 07", 0, 0, 0, 1.0)], schemas.STATES)
    named = {r.state_fips: r.name for r in manifest.name_states(states, dims.states(spark)).collect()}
    assert named == {"06": "California", "07": "State 07"}


def test_reconcile(spark):
    files = spark.createDataFrame([
        ("out/06/a.zip", "x/a.zip", "completed", "06", 1, None, None, 1.0),
        ("out/06/b.zip", "x/b.zip", "completed", "06", 1, None, None, 1.0),
        ("elsewhere/c.zip", "x/c.zip", "completed", "06", 1, None, None, 1.0),
        ("out/06/d.zip", "x/d.zip", "partial", "06", None, 3, None, 1.0),
    ], schemas.FILES)
    listing = spark.createDataFrame(
        [("out/06/a.zip", 10), ("out/06/d.zip", 40), ("out/06/e.zip", 50), ("elsewhere/c.zip", 9)],
        "path string, length bigint",
    )
    pending = spark.createDataFrame(
        [("06", "x/d.zip"), ("06", "x/e.zip"), ("06", "y/e.zip"), ("06", "x/f.zip")], "state_fips string, url string"
    )
    diff = worklist.reconcile(pending, files, listing, "out")
    got = sorted((r.outcome, r.path, r.url, r.size) for r in diff.collect())
    assert got == [
        ("missing", "out/06/b.zip", "x/b.zip", None), ("missing", "out/06/c.zip", "x/c.zip", None),
        ("updated", "out/06/d.zip", "x/d.zip", 40), ("updated", "out/06/e.zip", "x/e.zip", 50),
    ]
    recorded = worklist.reconcile(pending, files, listing, "out", recorded_paths=True)
    assert tuple(worklist.reconcile_counts(recorded).first()) == (2, 1)
    marks = worklist.reconcile_marks(diff, 100, 7.0)
    assert marks.columns == [f.split()[0] for f in schemas.MARK_EVENTS.split(", ")]
    rows = marks.collect()
    assert len({r.seq for r in rows}) == 2 and min(r.seq for r in rows) >= 100
    (row,) = manifest.fold_files(marks).where("path = 'out/06/e.zip'").collect()
    assert (row.status, row.size) == ("completed", 50)


def test_outcomes(spark):
    rows = [(1, 1.0, "completed", "u", "p", "06", 1, None, None), (2, 2.0, "failed", "u", "q", "06", None, None, "HTTP 404"),
            (3, 3.0, "failed", "u", "r", "13", None, None, "timed out"), (4, 4.0, "partial", "u", "r", "13", None, 1, None)]
    marks = spark.createDataFrame(rows, schemas.MARK_EVENTS)
    got = {(r.state_fips, r.level): tuple(r)[2:] for r in worklist.outcome_counts(marks).collect()}
    assert got == {("06", 0): (1, 0, 1), ("13", 0): (0, 1, 0), (None, 1): (1, 1, 1)}
    odd = marks.where("kind = 'failed'").limit(1).select("seq", "ts", "kind", "url", "path", "state_fips", "size", "bytes_downloaded")
    texts = ["error 4040", "14048", "status=404", "404", "Not Found", "http/1.1 404 gone"]
    shown = odd.crossJoin(marks.sparkSession.createDataFrame([(t,) for t in texts], "error string"))
    assert worklist.outcome_counts(shown).where("level = 1").first().not_found == 4
    plain = worklist.outcome_counts(marks, not_found_from_error=False).where("level = 1").first()
    assert tuple(plain)[2:] == (1, 2, 0)


@pytest.fixture
def tables(history):
    _, marks, calls = history
    return {
        "files": manifest.fold_files(marks), "url_lists": manifest.fold_url_lists(marks),
        "states": manifest.fold_states(marks, calls), "discovered_urls": manifest.fold_discovered(calls),
    }


def test_json_document(spark, tables, tmp_path):
    manifest_json.write_document(tables, str(tmp_path / "doc"))
    parts = sorted(glob.glob(str(tmp_path / "doc" / "part-*")))
    text = "".join(open(p).read() for p in parts)
    document = json.loads(text)
    assert list(document) == ["files", "completed", "failed", "states", "discovered_urls"]
    assert document["files"] == {r.path: r.asDict() for r in tables["files"].collect()}
    assert document["states"] == {r.state_fips: r.asDict() for r in tables["states"].collect()}
    known = {}
    for r in tables["discovered_urls"].collect():
        known.setdefault(r.state_fips, set()).add(r.url)
    assert {s: set(u) for s, u in document["discovered_urls"].items()} == known
    for kind in ("completed", "failed"):
        assert document[kind] == sorted(r.url for r in tables["url_lists"].where(F.col("list_type") == kind).collect())
    whole = tmp_path / "manifest.json"
    whole.write_text(text)
    back = manifest_json.read_document(spark, str(whole))
    assert sorted(map(str, back["files"].collect())) == sorted(map(str, tables["files"].collect()))
    assert sorted(map(str, back["states"].collect())) == sorted(map(str, tables["states"].collect()))
    assert back["url_lists"].count() == tables["url_lists"].count()
    assert back["discovered_urls"].count() == tables["discovered_urls"].count()


def test_json_in_several_documents(spark, tables, tmp_path):
    path = str(tmp_path / "docs")
    manifest_json.write_document(tables, path, 5)
    lines = [line for p in glob.glob(f"{path}/part-*") for line in open(p)]
    assert len(lines) == 5 and all(isinstance(json.loads(line)["files"], dict) for line in lines)
    back = manifest_json.read_document(spark, path)
    for name, columns in (("files", "*"), ("states", "*"), ("url_lists", "url, list_type"), ("discovered_urls", "state_fips, url")):
        got, want = (t[name].selectExpr(*columns.split(", ")).collect() for t in (back, tables))
        assert sorted(map(str, got)) == sorted(map(str, want)) and got
    (tmp_path / "bad.json").write_text('{"files": {"a": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        manifest_json.read_document(spark, str(tmp_path / "bad.json"))["files"].collect()


def test_json_of_an_empty_manifest(spark, tmp_path):
    empty = manifest_json.empty_tables(spark)
    manifest_json.write_document(empty, str(tmp_path / "doc"))
    text = "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / "doc" / "part-*"))))
    assert json.loads(text) == {"files": {}, "completed": [], "failed": [], "states": {}, "discovered_urls": {}}
    for read in (manifest_json.read_document, manifest_json.read_entries):
        got = read(spark, str(tmp_path / "absent"))
        assert {n: t.count() for n, t in got.items()} == dict.fromkeys(manifest_json.TABLES, 0)


def test_json_entries(spark, tables, tmp_path):
    manifest_json.write_entries(tables, str(tmp_path / "lines"))
    back = manifest_json.read_entries(spark, str(tmp_path / "lines"))
    for name, table in tables.items():
        assert sorted(map(str, back[name].collect())) == sorted(map(str, table.collect()))
