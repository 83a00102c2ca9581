"""Small tables with awkward rows, and plain versions of shared rules."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=()):
    """Documents from (id, text); `extra` names more columns, which may clash with those of results."""
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    for name in extra:
        df = df.selectExpr("*", f"'other' as `{name}`")
    return df


def words(text):
    """Words of the near-duplicate and language model contracts."""
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "Zwei wörter"),
    (6, "same text of several words that repeats here"),
    (7, "same text of several words that repeats here"),
    (8, "SAME text of several words that repeats HERE"),
    (9, "x" * 5000),
    (10, "long " * 3000),
    (11, "emoji 😀 and ▁ marks\x00 and \u00a0 blanks"),
    (None, "row without id"),
    (6, "same text of several words that repeats here"),
]
