from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, a long, hash long"
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(3, 7))) for _ in range(n))


def corpus() -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and columns with clashing names."""
    base, shared = prose(1, 120), prose(2, 60)
    changed = base.split(" ")
    changed[50] = "other"
    texts = {1: base, 2: base, 3: base + " tail", 4: " ".join(changed), 5: None, 6: "", 7: " \t\n ", 8: "one two",
             9: "ONE  two", 10: prose(3, 40) + "\n" + shared + "\n" + prose(4, 40), 11: prose(5, 30) + " " + shared.upper(),
             12: prose(6, 20000), 13: "b " * 500, 14: "b " * 400, 15: "été à Ünïcode 文字 <|endoftext|> \x00 x", 16: base}
    rows = [(k, t, "en" if k % 3 else "fr", None if k % 5 == 0 else f"s{k % 4}", len(t or "")) for k, t in texts.items()]
    rows += [rows[2], (None, "null id text here now", None, "s1", 21), (None, None, None, None, None)]
    rows += [(100 + k, prose(100 + k, 80), "en", f"s{k % 4}", 1) for k in range(20)]
    return [(*r, 0.5, "x", 9, 9) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)
