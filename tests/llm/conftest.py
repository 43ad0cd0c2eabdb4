from __future__ import annotations

import random

import pytest

from daybook.llm.shared import ship

#: Columns that operators might use inside, as the caller's own.
CLASH = ("doc", "hash", "node", "key", "place", "n", "anchor", "line", "row", "tags", "lang_pred", "kept")
SCHEMA = "doc_id bigint, text string, lang string, " + ", ".join(f"{c} string" for c in CLASH)


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


def sentences(seed: int, lines: int, words: int = 9) -> str:
    r = random.Random(seed)
    stock = ["river", "stone", "walks", "under", "green", "of", "the", "and", "light", "market", "seven", "house", "song", "añil", "grün", "over"]
    return "\n".join(" ".join(r.choice(stock) + (r.choice("abcdefgh") if r.random() < 0.4 else "") for _ in range(words)) + "." for _ in range(lines))


def edge_texts() -> list[tuple[int | None, str | None]]:
    a, b, long = sentences(1, 12), sentences(2, 9), sentences(3, 900, 20)
    near = a.replace("stone", "stony", 1)
    shared = sentences(4, 3, 30)
    return [
        (1, a), (2, b), (3, a), (3, a), (4, near), (5, None), (6, ""), (7, " \n\t \n"), (8, "x"), (9, "x"),
        (10, long), (11, sentences(5, 4) + "\n" + shared + "\n" + sentences(6, 4)), (12, sentences(7, 5) + "\n" + shared),
        (None, sentences(8, 6)), (None, None), (13, "the the the the the " * 60), (14, sentences(9, 6) + "\n" + sentences(9, 6)),
        (15, "Ünïcode 漢字 ’s 😀\x0b\x85 tail\r\nline " * 8), (16, a + "\n" + sentences(10, 1)), (-17, sentences(11, 8)), (18, "one two three four"), (19, "ONE two three FOUR"),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns."""
    rows = [(i, t, "en", *(f"{c}!" for c in CLASH)) for i, t in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
