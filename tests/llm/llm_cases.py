from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, part int, block long, fp long, first_time double, _row long, hits string"


def corpus(n: int = 60, seed: int = 5) -> list[tuple]:
    """Small documents with nulls, empty and long texts, copies, near copies, repeated rows and shared passages."""
    rng = random.Random(seed)
    vocabulary = {
        "en": ["the", "of", "and", "thing", "other", "reading", "Water,", "house.", "with", "from", "when", "light"],
        "de": ["der", "und", "die", "nicht", "Straße", "über", "größer,", "wenn", "zwischen", "haus.", "schön", "werden"],
        "fr": ["le", "et", "les", "été", "où", "français", "être,", "quand", "maison.", "toujours", "garçon", "avec"],
    }
    shared = " ".join(rng.choice(vocabulary["en"]) for _ in range(60))
    rows: list[tuple] = []
    for i in range(n):
        lang = rng.choice(sorted(vocabulary))
        text = " ".join(rng.choice(vocabulary[lang]) for _ in range(rng.randint(1, 90)))
        if i % 7 == 3:
            text += "\n" + shared
        if i % 11 == 5 and rows:
            text = rows[-1][1]
        if i % 13 == 6 and rows and rows[-1][1]:
            text = rows[-1][1] + " end"
        rows.append((i, text, lang if i % 9 else None, f"s{i % 4}" if i % 10 else None))
    rows += [
        (n, None, "en", "s0"), (n + 1, "", None, "s1"), (n + 2, " \t\n", "de", None), (n + 3, "123 ... 456", "en", "s2"),
        (n + 4, "word", "en", "s1"), (n + 5, "ab " * 20_000, "en", "s3"), (None, "an id that is null", "en", "s2"),
        (7, rows[7][1], rows[7][2], rows[7][3]),
    ]
    return [(*r, len(r[1]) if r[1] else None, 1, 2, 3, 4, 0.5, 6, "x") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(n: int, pairs) -> list[int]:
    """Smallest member of each one's group."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
