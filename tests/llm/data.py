"""Small tables and plain versions of the operators' rules."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, spans string, own_text string, score string, _class string"


def table(spark, rows):
    """doc_id, text and columns whose names operators use themselves."""
    full = [(i, t, f"s{k}", f"o{k}", f"c{k}", f"k{k}") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    parts = ["the", "of", "re", "an", "tion", "er", "in", "é", "ß", "on"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


#: Nulls, empty texts, ties, repeated rows, odd characters, a long text.
EDGES = [
    (1, None), (2, ""), (3, "  \n\t "), (None, "no id at all, but words enough to be a document of its own kind"),
    (4, "x"), (5, prose(5, 60)), (5, prose(5, 60)), (6, prose(5, 60)), (7, prose(7, 5000)),
    (8, "a" * 3000), (9, "日本語の文 and 한국어, العربية 🙂 é ² ½ ª x y\x1cz"), (10, "It's <|endoftext|> we'll\r\n\r\n  see  "),
    (11, prose(11, 40) + "\n" + prose(11, 40)), (None, None),
]

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def ascii_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
