"""Small fixtures shared by the tests of the training-data operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width=5):
    w = words(lower(text))
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def docs(spark, rows):
    """Documents from (doc_id, text, source) with clashing extra columns."""
    data = [(i, t, "en", s, len(t or ""), 7, 7) for i, t, s in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, id long, n long")


#: Null and empty texts, null ids, white space only, one word, no spaces, repeated rows.
ODD = [(1, None, "a"), (2, "", "a"), (None, "null id text of six words here", None), (3, " \t\n ", None), (4, "one", "b"),
       (5, "x" * 5000, "b"), (6, "same row twice", "b"), (6, "same row twice", "b"), (7, "é\u3000ü\u00a0 z 🎉", "c")]
