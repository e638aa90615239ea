"""Filter audit, token records and hard negatives against brute force, with every odd case."""

from __future__ import annotations

import itertools
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.utils import PythonException

from centerline.llm import filter_audit, hard_negatives, records
from centerline.llm.checksums import MASK, Crc32c

BPE = public_tokenizers.path("byte_bpe_50k.json")


# Filter audit


def masks(rows):
    order = lambda i: (i is None, i or 0)
    least = {}
    for i, t in rows:
        least[t or ""] = min(least.get(t or "", (True, 1 << 70)), order(i))
    out = []
    for i, t in rows:
        t = t or ""
        w = brute.words(t)
        out.append("".join(c for c, failed in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= x <= "Z" for x in t) > 10 * len(t),
            any(x in "#$%&*|" for x in t), order(i) > least[t],
        )) if failed))
    return out


def audited(rows, parts, marks):
    """All rows of the audit, by walking every document through every order."""
    found = masks(rows)
    out = {}
    shapley = Counter()
    for part in sorted(set(parts)):
        own = [(m, *marks.get(i, (0, 0))) for (i, _), p, m in zip(rows, parts, found) if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(own)
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                out[part, order, step] = (
                    len(left), len(gone), sum(c in d[0] for d in own) - len(gone), sum(d[0] == c for d in own),
                    sum(d[1] for d in gone), sum(d[2] for d in gone),
                )
                shapley[part, c] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_against_walks(spark, docs, rows, labels):
    parts = [["en", "fr", None][(i or 0) % 3] or "" for i, _ in rows]
    marks = {i: (int(bool(i % 4)), 0) for i, _ in rows if i is not None}
    found = filter_audit.interactions(docs, labels).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in found}
    assert len(found) == len(got) == 3 * 600
    assert got == audited(rows, parts, marks)


def test_audit_of_edges(spark, nothing, labels):
    assert filter_audit.interactions(nothing, labels).count() == 0
    hundred = " ".join(f"w{i}" for i in range(100))
    rows = [
        (1, hundred), (2, " ".join(f"w{i}" for i in range(80)) + " w1" * 20), (3, "A" * 10 + "é" * 90), (4, "A" * 11 + "é" * 90),
        (5, hundred), (5, hundred), (1, hundred), (None, hundred), (6, "\x1cx y z"), (7, hundred + " |"), (8, None), (9, ""),
    ]
    data = spark.createDataFrame([(i, t, None, 1, "x") for i, t in rows], "doc_id long, text string, lang string, n int, mask string")
    marked = spark.createDataFrame([(1, 0, 1), (1, 1, None), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in filter_audit.interactions(data, marked).collect()}
    assert got == audited(rows, [""] * len(rows), {1: (1, 1), 8: (0, 1)})


def test_audit_plan_is_native(docs, labels):
    plan = filter_audit.interactions(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Token records


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a\n b", "a \nb", "a\n  b c", "x <|endoftext|> y", "a\n\nb", "a\n\n", "a\n\n\nb c", "\n", "\n\n",
    "it's he'll 12. 3.\nSo, (yes)!", "é ü 日本 語", "a\tb c", "\x1c a b", "a \x85b", "a\x00 b", "​a　 b", "😀  😀", "a.\nb.\nc", "a\r\nb",
]


def test_encoder_is_the_library(library):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice(" \n\tab1.,é　<|endoftext|>'s") for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    encoder = records.Encoder(BPE, limit=200)
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [x for at in range(0, len(texts), 97) for x in encoder.of(pa.array(texts[at:at + 97]))]
    assert got == want


def test_odd_white_space_is_cut(library):
    words = ["".join(rng.choice("abcdeé") for _ in range(6)) for rng in map(random.Random, range(50))]
    texts = [random.Random(i).choice(["  ", "\t", " \n", "\n\n\n", ", "]).join(words) + ". " for i in range(200)]
    encoder, sent = records.Encoder(BPE), []
    whole = encoder._whole
    encoder._whole = lambda own: sent.extend(own) or whole(own)
    assert encoder.of(pa.array(texts)) == [
        np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)
    ]
    assert 20 * sum(map(len, sent)) < sum(map(len, texts))  # the library gets what is equal once, not whole texts


def test_parts_have_the_pre_tokens_of_the_whole(library):
    """Letters of two bytes, quotes, and characters that some library counts as white space, beside each other."""
    rng = random.Random(6)
    kinds = [" ", "  ", "\n", "\t", "\r\n", "a", "é", "ª", "×", "÷", "ß", "\u0301", "'", "'s", "1", "²", "٣", ".", "\0", "\x1c", "\x1f", "\x7f",
             "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u200b", "\u2028", "\u202f", "\u205f", "\u3000", "\ufeff", "日", "😀", "я", "”", "。"]
    texts = [f"a{c},{c}b 1{c}2 {c}'{c}  {c}" for c in map(chr, range(0xA0, 0x300))]
    for _ in range(4000):
        some = rng.sample(kinds, rng.randint(2, 8))
        texts.append("".join(rng.choice(some) for _ in range(rng.randint(0, 12))))
    encoder = records.Encoder(BPE, limit=300)
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x for at in range(0, len(texts), 101) for x in encoder.of(pa.array(texts[at:at + 101]))] == want


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(records, "CACHE_BYTES", 5000)
    encoder = records.Encoder(BPE)
    for i in range(30):
        text = "".join(random.Random(i).choices("abcd ", k=3000)) + " " + "x" * 9000
        assert encoder.of(pa.array([text])) == [np.array(library.encode(text).ids, "<u2").tobytes()]
        assert sum(map(len, encoder.units.to_pylist())) <= 5000


def test_other_patterns_get_whole_texts(library, tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    other = Tokenizer.from_file(BPE)
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("e", "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=True)])
    other.save(str(tmp_path / "other.json"))
    texts = ["the tree, here 12", "", "a  e\n", *ODD]
    assert records.Encoder(BPE).of(pa.array(["", ""])) == [b"", b""]
    want = [np.array(e.ids, "<u2").tobytes() for e in other.encode_batch(texts, add_special_tokens=False)]
    assert records.Encoder(str(tmp_path / "other.json")).of(pa.array(texts)) == want


def test_checksums():
    crc = Crc32c()
    assert crc.of([b"123456789", b"\0" * 32, b"\xff" * 32]).tolist() == [0xE3069283, 0x8A9136AA, 0x62A8AB43]  # published values
    rng = random.Random(1)

    def slow(data):
        x = 0xFFFFFFFF
        for b in data:
            x = int(crc.byte[(x ^ b) & 0xFF]) ^ x >> 8
        return x ^ 0xFFFFFFFF

    data = [rng.randbytes(n) for n in (4, 5, 63, 64, 65, 127, 128, 129, 1000, 5000)]
    assert crc.of(data).tolist() == [slow(d) for d in data]
    x = slow(data[0])
    assert crc.masked(data[:1])[0] == ((x >> 15 | x << 17) + int(MASK)) & 0xFFFFFFFF


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, zlib.crc32((r[1] or "").encode())))


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records"))
    return records.write_records(docs, path, BPE), path


def test_records_read_back(stored, rows, library):
    index, path = stored
    found = records.read_records(index, path, BPE).join(records.starts(index), "part").collect()
    want = by_id(rows)
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for _, t in want]
    starts = [0, *itertools.accumulate(map(len, ids))]
    got = sorted(found, key=lambda r: r.start + r.before)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    assert [list(r.ids) for r in got] == ids
    assert [r.start + r.before for r in got] == starts[:-1]
    found = records.check_records(index, path, BPE).join(records.starts(index), "part").collect()
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in sorted(found, key=lambda r: r.start + r.before)] == [
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), x in zip(want, ids)
    ]


def test_files_hold_only_what_the_index_names(stored):
    index, path = stored
    sizes = defaultdict(int)
    for r in index.collect():
        assert r.offset <= sizes[r.file] or sizes[r.file] == 0
        sizes[r.file] += r.length + 16
    assert {f: os.path.getsize(f"{path}/records/{f}") for f in os.listdir(f"{path}/records")} == dict(sizes)


def test_shuffled_reads(spark, stored):
    index, path = stored
    plain = Counter((r.doc_id, tuple(r.ids)) for r in records.read_records(index, path, BPE).collect())
    one, again, other = (
        [(r.doc_id, tuple(r.ids)) for r in records.read_records(records.shuffled(index, seed), path, BPE).collect()] for seed in (1, 1, 2)
    )
    assert Counter(one) == Counter(other) == plain
    assert one == again != other


@pytest.mark.parametrize("at", [3, 9, 30, -2])
def test_a_broken_record_is_found(spark, docs, tmp_path, at):
    path = str(tmp_path / "broken")
    index = records.write_records(docs.limit(20).coalesce(1), path, BPE)
    name = f"{path}/records/{os.listdir(f'{path}/records')[0]}"
    data = bytearray(open(name, "rb").read())
    data[at] ^= 4
    open(name, "wb").write(data)
    with pytest.raises(PythonException, match="BrokenRecord"):
        records.check_records(index, path, BPE).collect()


def test_records_of_an_empty_table(spark, nothing, tmp_path):
    index = records.write_records(nothing, str(tmp_path / "none"), BPE)
    assert index.count() == 0 and records.read_records(index, str(tmp_path / "none"), BPE).count() == 0


# Hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, query int, p string"


def vectors(seed, n=900, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width))
    out = []
    for i in range(n):
        v = centres[i % 5] + rng.normal(size=width) * 0.4
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(0, 4))))
    hot = out[3][1]
    out = [(i, hot, 1) if i % 3 == 0 else r for i, r in enumerate(out)]  # a third of all rows
    return out + [
        (900, None, 1), (901, [1.0, None, 0.0], 2), (902, [math.nan] * width, 2), (903, [math.inf] + [0.0] * 5, 1), (904, hot, None),
        (None, [0.9] * width, 2), (1000, [0.0] * width, 1), (1100, [-x for x in hot], 2), (1200, [0.5, 0.5], 3), (1300, [], 0), (100, hot, 1),
    ]


def mined(rows):
    rows = sorted({(i if i is not None else 1 << 63, tuple(math.floor(256 * x) for x in v), y) for i, v, y in rows
                   if v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for a, v, y in rows:
        if a == 1 << 63 or a % 100:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, u)), i, k) for i, u, k in rows if i != a))
        for p, i, _ in [s for s in scored if s[2] == y][:5]:
            near = [s for s in scored if s[2] != y and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(near, 1)]
    none = lambda i: None if i == 1 << 63 else i
    return Counter((a, none(i), n, none(j), p, s) for a, i, n, j, p, s in out)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("MEMBERS", 2), ("GROUP", 2), ("BLOCK", 40), ("STEP", 16), ("SLICE", 2)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(1)
    data = spark.createDataFrame([(i, v, y, 0, "x") for i, v, y in rows], VECTORS).repartition(4)
    found = hard_negatives.hard_negatives(data)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = Counter(map(tuple, found.collect()))
    assert got == mined(rows) and len(got) > 200


def test_negatives_without_rows(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(100, [1.0], 1, 0, "")], VECTORS)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(1, [1.0], 1, 0, ""), (2, [1.0], 2, 0, "")], VECTORS)).count() == 0


def test_bounds_are_bounds():
    rng = np.random.default_rng(2)
    items, queries = rng.integers(-300, 300, (500, 8)), rng.integers(-300, 300, (60, 8))
    items[0], queries[0] = 0, 0
    centres = hard_negatives._centres(queries.astype(float), 4)
    lengths, angles = hard_negatives._angles(queries, centres)
    for c in range(len(centres)):
        mine = np.argmin(angles, axis=1) == c
        n, a = hard_negatives._angles(items, centres)
        bound = hard_negatives._bound(n, a[:, c], angles[mine, c].max(initial=0.0))
        assert (queries[mine] @ items.T <= lengths[mine, None] * bound[None, :] + 1e-6).all()
