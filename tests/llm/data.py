"""Small documents with the awkward cases: null, empty, very long, tied and repeated rows."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def sentence(seed, n):
    return " ".join(words(seed, n))


def row(i, text, lang="en", source="s0"):
    return (i, text, lang, source, len(text or ""))


def awkward():
    """Rows every operator must take."""
    return [
        row(1, None),
        row(2, ""),
        row(3, "  \n\t "),
        row(4, sentence(4, 30_000), source="s1"),
        row(5, sentence(5, 40), lang=None, source=None),
        row(6, sentence(5, 40), source="s1"),
        row(6, sentence(5, 40), source="s1"),
        row(7, "x" * 200_000, source="s2"),
        row(8, "Grüße 😀 e\u0301 漢字 " + sentence(8, 12), lang="de", source="s2"),
        row(None, sentence(9, 20), source="s2"),
        row(10, "a b", lang="fr"),
    ]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
