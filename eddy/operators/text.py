"""P3 tokenizer and the word counts (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.keyed import keyed_running

# Fixed value: the tokenizer splits on runs of non-word characters (ASCII word class).
SPLIT_PATTERN = r"\W+"


def tokens(lines: DataFrame, line_col: str = "line", keep: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """Lower-case, split on non-word runs, drop empty pieces: one row per token with
    its position in the line (whole lines, no truncation)."""
    t = lines.select(*keep, F.posexplode(F.split(F.lower(F.col(line_col)), SPLIT_PATTERN)).alias("pos", "word"))
    return t.filter(F.length("word") > 0)


def word_count(tok: DataFrame) -> DataFrame:
    """A2 final form: ``keyBy(word).sum(1)`` after the last token. A hot word is combined
    map-side (partial aggregation) before the shuffle."""
    return tok.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_running(tok: DataFrame, order=("doc_id", "line_no", "pos")) -> DataFrame:
    """A2 change log: every token emits its word's new total, in reading order. The
    running count is the skew-safe keyed scan (a word too frequent for a task is split)."""
    r = keyed_running(tok, ["word"], list(order), {"n": ("count", None)})
    return r.select(*order, "word", "n")
