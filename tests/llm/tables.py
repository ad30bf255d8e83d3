"""Small tables for the tests, odd ones included."""

import random

WORDS = [a + b + c for a in ("ta", "ri", "mo", "ne") for b in ("la", "ku", "si", "vo", "pe") for c in ("n", "r", "st", "d")]
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABELS = "doc_id bigint, quality int, toxic int"
BENCHMARK = "item_id bigint, text string"
PAGES = "page_id bigint, url string, html string"


def prose(rng, n):
    out = []
    for i in range(n):
        word = rng.choice(WORDS)
        out.append(word.capitalize() + "." if rng.random() < 0.1 else word)
    return " ".join(out)


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None if text is None else len(text))


#: Nulls, empty and blank texts, repeated rows, one id with two texts, long text.
ODD = [
    row(1, None), row(2, ""), row(3, " \t\n"), row(4, "one"), row(4, "one"), row(5, "two words"), row(5, "two others"),
    row(None, "no id here"), row(None, None, None), (6, "nothing else", None, None, None), row(7, "long " * 30_000, "b"),
]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(docs):
    """The table with extra columns named like those that operators use inside."""
    from pyspark.sql import functions as F

    names = (
        "key_id key_text row whole kept copies size point target taken source_size fp root component_id node "
        "label words place kind start end spans score cosine item_id host page plan part bucket draw in_mix mix_id"
    ).split()
    return docs.withColumns({n: F.lit(7) for n in names})


def values(df):
    from collections import Counter

    return Counter(map(tuple, df.collect()))


def some_documents(n=120, seed=1):
    rng = random.Random(seed)
    rows = [row(i, prose(rng, rng.randint(1, 200)), rng.choice("abc")) for i in range(n)]
    return rows + [row(n + i, rows[i][1], "a") for i in range(10)]
