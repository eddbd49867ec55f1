"""Small tables with the cases every operator must stand, and brute-force counterparts."""

import re

SPACE = "[\x20\x09-\x0d]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, digest string, word int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def documents(spark, rows):
    """Documents from (doc_id, text) with extra columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1) for i, t in rows], DOCS)


ODD = [
    (1, "One two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (5, "word"),
    (None, "no id here at all"),
    (7, "ß é 你好 🙂 café\r\nline"),
    (7, "ß é 你好 🙂 café\r\nline"),
    (8, "Same same SAME " * 40),
    (9, "x" * 70_000 + " tail"),
]
