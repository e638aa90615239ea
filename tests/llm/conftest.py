from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, m string, doc string"


def _prose(rng: random.Random, n: int, kinds: int = 4000) -> list[str]:
    return [f"w{int(rng.paretovariate(0.7)) % kinds}" + rng.choice(["", "", ",", "é"]) for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """Texts with copies, near-copies, shared passages, runs, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(5)
    passage, short = " ".join(_prose(rng, 70)), " ".join(_prose(rng, 25))
    long = " ".join(_prose(rng, 9000))
    out = []
    for i in range(150):
        own = _prose(rng, rng.randint(12, 160))
        text = " ".join(own)
        if i % 5 == 0:
            text = " ".join(own[:20]) + "\n" + passage + "\n\n" + " ".join(own[20:])
        if i % 7 == 0:
            text += "\t" + short
        if i % 9 == 0 and i:
            text = out[i - 9][1]  # a copy
        if i % 11 == 0 and i:
            text = out[i - 1][1] and out[i - 1][1] + " more"
        if i % 13 == 0:
            text = "\n".join([" ".join(own[:6])] * 5 + own)
        out.append((i, text))
    out += [
        (150, None), (151, ""), (152, " \n\t "), (153, "one"), (154, "two words"), (155, "a " * 400), (156, long),
        (157, "x " + long + " y"), (158, "<|endoftext|> a<|endoftext|>b ▁ 日本語 😀  é"), (3, out[3][1]),
        (4, "same id " + passage), (None, passage), (None, None), (None, passage + " tail"), (159, passage.upper()),
        (160, ("b c " * 40) + passage), (161, "Ünï " * 3 + "\x0b\x0c\r" + short), (162, "#*$%&|<> | " * 12),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    data = [
        (i, t, ["en", "fr", None][(i or 0) % 3], "s", None if t is None else len(t), 7, "m", "d") for i, t in rows
    ]
    return spark.createDataFrame(data, DOCS).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def items(rows):
    text = rows[0][1].split("\n")[1]
    return [
        (1, text[:200]), (2, "Two  words"), (3, None), (None, "one"), (4, ""), (5, rows[8][1]), (10, text[:200]), (6, "!!"),
        (7, rows[156][1][4000:4200]),
    ]


@pytest.fixture(scope="session")
def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture(scope="session")
def labels(spark, rows):
    return spark.createDataFrame(
        [(i, i % 4 and 1, 0) for i, _ in rows if i is not None] + [(None, 1, 0), (5, None, None)],
        "doc_id long, quality int, toxic int",
    )
