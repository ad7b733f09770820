"""Small tables with the awkward rows that every operator has to take."""
from __future__ import annotations

import random

WORDS = [f"{a}{b}" for a in ("ab", "co", "de", "fi", "gu", "ha", "jo", "ki", "lu", "me") for b in ("ra", "ten", "so", "vil", "x")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_texts() -> list[str | None]:
    rng = random.Random(5)
    long_text = " ".join(sentence(rng, 12) + ("\n" if i % 3 else ".") for i in range(2500))
    same = sentence(rng, 80)
    return [None, "", "   \n\t ", "a", "one two three", same, same, same + " x", "é ü ñ ß " * 40, "#$% & | <> 1 2 3 \U0001f642", long_text,
            "same line\nsame line\nsame line", sentence(rng, 60), "\n\n\n", "In. " * 200, "x" * 5000]


def edge_docs(spark):
    """The texts above, a null id, an id given twice, and null columns."""
    rows = [(i, t, "en" if i % 3 else None, None, None) for i, t in enumerate(edge_texts())]
    rows += [(None, "no id at all here", None, "s", 1), (5, edge_texts()[5], "en", "s", 2)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t in enumerate(texts)], DOCS)
