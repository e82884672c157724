"""Rows that every operator must stand: nulls, empty and long texts, repeated rows, clashing columns."""

from __future__ import annotations

import random

CLASHING = ("ids", "n_words", "kept", "distance", "fp", "uid", "row", "text_hash", "n_tokens", "base_spans", "size", "shard")
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING)


def words(seed: int, n: int, size: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeiklmnorstu", k=rng.randint(2, 8))) for _ in range(n)) if size else ""


def texts() -> list[str | None]:
    return [
        None,
        "",
        " \n\t ",
        "one",
        "été naïve 中文 😀 word",
        words(1, 120),
        words(1, 120),
        words(2, 6_000),
        "x" * 120_000,
        words(3, 90) + "\n" + words(3, 90),
        "password = hunter2secret and AKIA" + "A1B2" * 5 + " " + "deadbeef" * 5,
    ]


def rows() -> list[tuple]:
    """(doc_id, text, lang, source, clashing ...): two rows are the same, one has no id, some no language."""
    out = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else "s", *CLASHING) for i, t in enumerate(texts())]
    return [*out, out[5], (None, words(4, 70), None, None, *CLASHING)]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
