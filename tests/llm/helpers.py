"""Brute-force parts that several tests share."""

import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width=5):
    w = words(text)
    if len(w) >= width:
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return {tuple(w)} if w else set()


def documents(spark, rows):
    """(doc_id, text) rows as documents, with source and a column of a clashing name."""
    full = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "x") for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, label string")


def odd_rows():
    """Nulls, empty, blank, one-word, very long and repeated texts, a null and a repeated id."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(200_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, long), (6, long), (7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f g"), (8, "ünï 😀 ß")]


def empty(frame):
    return frame.where(F.lit(False))
