"""Comment cleaning, counting and top words."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import (
    is_countable,
    spaced_words,
    without_stopwords,
    without_words,
    words,
)
from tallyforge.operators.keyed import best_per_key
from tallyforge.session import materialise

# The sentiments that count, and the word-count threshold
SENTIMENTS = ("positive", "negative")
MIN_WORD_COUNT = 500
TOP_WORDS = 5

Stopwords = Iterable[str] | DataFrame


def clean_text(
    df: DataFrame, text: str, stopwords: Stopwords, out: str = "cleaned"
) -> DataFrame:
    """The text in lower case without stopwords; rows left without any word go. The
    test is part of a generator, since a filter would clean each text again.

    A list of stopwords is tested word by word. A DataFrame with a column `word`, for lists of
    any length, is joined to the distinct words of each text, and the text loses what was found;
    for that the rows are numbered and written once. A stopword that stands in every text is a
    skewed side of a plain join, which Spark splits."""
    if isinstance(stopwords, DataFrame):
        df, found = _found_stopwords(df, text, stopwords)
        df = df.withColumn(found, without_words(F.col(text), F.col(found)))
        cleaned = F.array(F.col(found))
    else:
        found, cleaned = None, F.array(without_stopwords(F.col(text), stopwords))
    kept = df.select("*", F.explode(F.filter(cleaned, lambda c: F.length(c) > 0)).alias(out))
    return kept.drop(found) if found else kept


def _found_stopwords(df: DataFrame, text: str, stopwords: DataFrame) -> tuple[DataFrame, str]:
    """The rows with an array of the stopwords that stand in their text, and its name."""
    taken = {"word", *(c.lower() for c in df.columns)}
    row, found = (_unused(name, taken) for name in ("row", "found"))
    rows = materialise(df.withColumn(row, F.monotonically_increasing_id()))
    words = F.explode(F.array_distinct(spaced_words(F.col(text)))).alias("word")
    listed = stopwords.select("word").distinct()
    hits = rows.select(row, words).join(listed, "word", "left_semi")
    per_row = hits.groupBy(row).agg(F.collect_set("word").alias(found))
    joined = rows.join(per_row, row, "left")
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), found), found


def _unused(name: str, taken: set[str]) -> str:
    while name in taken:
        name += "_"
    return name


def explode_words(
    df: DataFrame, text: str, stopwords: Iterable[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per counted word, beside the columns `keep`."""
    tokens = df.select(*keep, F.explode(words(F.col(text))).alias("word"))
    counted = tokens.filter(is_countable(F.col("word")))
    stop = sorted(set(stopwords))
    return counted.filter(~F.col("word").isin(stop)) if stop else counted


def count_words(
    df: DataFrame, text: str, stopwords: Stopwords = (), classes: Sequence[str] = ()
) -> DataFrame:
    """Number `n` of each word, per class if classes are given.

    A list of stopwords is tested word by word. A DataFrame with a column `word`, for
    lists of any length, is anti-joined to the counts, where a word that makes up a
    large part of the text is one row and no longer a hot join key.
    """
    joined = isinstance(stopwords, DataFrame)
    tokens = explode_words(df, text, () if joined else stopwords, classes)
    counts = tokens.groupBy(*classes, "word").agg(F.count("*").alias("n"))
    if joined:
        counts = counts.join(stopwords.select("word").distinct(), "word", "left_anti")
    return counts


def word_frequency(
    df: DataFrame, text: str, stopwords: Stopwords = (), min_count: int = MIN_WORD_COUNT
) -> DataFrame:
    """Words that occur more than `min_count` times."""
    return count_words(df, text, stopwords).filter(F.col("n") > min_count)


def count_by(df: DataFrame, label: str) -> DataFrame:
    """Comments per non-empty label."""
    return df.filter(F.length(label) > 0).groupBy(label).agg(F.count("*").alias("n"))


def with_sentiment(df: DataFrame) -> DataFrame:
    """Only comments that are positive or negative."""
    return df.filter(F.col("sentiment").isin(*SENTIMENTS))


def aspect_sentiment(df: DataFrame) -> DataFrame:
    """Comments per aspect and sentiment."""
    return (
        with_sentiment(df)
        .filter(F.length("aspect") > 0)
        .groupBy("aspect", "sentiment")
        .agg(F.count("*").alias("n"))
    )


def aspect_extremes(df: DataFrame) -> DataFrame:
    """Per sentiment the aspect with most comments, on a tie the smaller name."""
    order = F.struct(-F.col("n"), F.col("aspect"))
    return (
        aspect_sentiment(df)
        .groupBy("sentiment")
        .agg(F.min_by("aspect", order).alias("aspect"), F.max("n").alias("n"))
    )


def top_words(
    df: DataFrame,
    classes: Sequence[str],
    text: str,
    stopwords: Stopwords = (),
    k: int = TOP_WORDS,
) -> DataFrame:
    """The `k` most frequent words per class, equal counts by word."""
    counts = count_words(df, text, stopwords, classes)
    return best_per_key(counts, classes, [F.desc("n"), F.asc("word")], k)


def top_words_line(top: DataFrame, classes: Sequence[str]) -> DataFrame:
    """The ranked words of each class as one text `word=n, word=n`."""
    entry = F.struct("rank", F.concat_ws("=", "word", F.col("n").cast("string")).alias("entry"))
    ranked = F.sort_array(F.collect_list(entry))
    line = F.array_join(F.transform(ranked, lambda e: e["entry"]), ", ")
    return top.groupBy(*classes).agg(line.alias("top_words"))
