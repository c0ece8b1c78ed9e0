"""Small tables with the cases every operator has to bear."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [word for word in SPACES.split(text or "") if word]


def frame(spark, rows):
    """Rows (doc_id, text, source) as documents."""
    full = [(number, text, "en", source, None if text is None else len(text)) for number, text, source in rows]
    return spark.createDataFrame(full, DOCS)


def prose(number, length):
    """Words that differ from those of any other number."""
    return " ".join(f"w{number}x{(number * 7919 + place * 104729) % 1000003}" for place in range(length))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, copies, repeated rows, a null id twice."""
    return [
        (1, prose(1, 120), "a"),
        (2, prose(1, 120), "b"),
        (2, prose(1, 120), "b"),
        (3, None, None),
        (4, "", "a"),
        (5, " \n\t ", "a"),
        (6, prose(6, 30_000), "b"),
        (7, "é \u00a0 \u2003x 漢字 😀 A a", None),
        (None, prose(8, 70), "a"),
        (None, None, None),
        (None, None, None),
        (9, "one", "c"),
    ]


def with_clash(df, *names):
    """The frame with more columns, named like those an operator adds, in another case at times."""
    for place, name in enumerate(names):
        df = df.withColumn(name.upper() if place % 2 else name, df["doc_id"] * 0 + 17)
    return df
