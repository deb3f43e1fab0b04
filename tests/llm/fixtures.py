"""Small tables and brute-force versions for the operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def doc_rows():
    """Nulls, empty, white space only, ties, repeated rows, a long text."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    long_text = " ".join(base[i * i % len(base)] + str(i % 97) for i in range(6000))
    return [
        (0, " ".join(base), "en", "a", 1), (1, " ".join(base), "en", "b", 1), (2, " ".join(base).upper(), "en", None, 1),
        (3, " ".join(base[:-1] + ["upsilon"]), "en", "a", 1), (4, None, None, None, None), (5, "", "en", "b", 0),
        (6, " \t\n ", "en", "c", 4), (7, "one two", "en", "c", 7), (8, "one two", "en", "c", 7), (9, "ünï cödé 漢字 😀 ok", "xx", "a", 9),
        (10, long_text, "en", "b", 1), (11, long_text + " more", "en", "b", 1), (12, "x" * 5000, "en", "a", 1),
        (None, "no id here at all", "en", "a", 1), (14, "one two", "en", "c", 7), (14, "one two", "en", "c", 7)]


def documents(spark, rows=None):
    """With extra columns whose names the operators use inside."""
    df = spark.createDataFrame(doc_rows() if rows is None else rows, DOC)
    return df.withColumns({"size": F.lit("x"), "rate": F.lit(1), "key": F.lit(2), "label": F.lit("z"), "id": F.lit(7)})


def linked_components(n, pairs):
    """Smallest member of each one's component."""
    lowest = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(lowest[a], lowest[b])
            if lowest[a] != m or lowest[b] != m:
                lowest[a] = lowest[b] = m
                changed = True
    return lowest


def cosine(x, y):
    return math.fsum(a * b for a, b in zip(x, y)) / math.sqrt(
        math.fsum(a * a for a in x) * math.fsum(b * b for b in y))
