"""Text queries over documents and their labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.text import spaced_words
from tallyforge.operators import text as ops
from tallyforge.plans.tables import spread, table

# English stopwords, since the documents are not Vietnamese
ENGLISH = tuple(
    """
a about after all also an and any are as at be been but by can could did do for from
had has have he her him his how i if in into is it its just like me more my no not now
of on one only or other our out over she so some than that the their them then there
these they this time to two up was we were what when which who will with would you your
""".split()
)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def _reviews(documents: DataFrame, folder: str) -> DataFrame:
    """Documents as comments: the language is the aspect and the category, the
    quality label the sentiment."""
    labels = table(documents.sparkSession, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment")
    )
    comments = documents.select(
        "doc_id", F.col("text").alias("comment"),
        F.col("lang").alias("aspect"), F.col("lang").alias("category"),
    )
    return comments.join(labels, "doc_id")


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(_documents(spark, folder).select("doc_id", "text"))
    return ops.clean_text(documents, "text", ENGLISH).select("doc_id", "cleaned")


def clean_text_joined_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    """The stopwords are a table: every word of the documents that begins with a vowel."""
    documents = spread(_documents(spark, folder).select("doc_id", "text"))
    words = documents.select(F.explode(spaced_words(F.col("text"))).alias("word")).distinct()
    stopwords = words.filter(F.substring("word", 1, 1).isin(*"aeiou"))
    return ops.clean_text(documents, "text", stopwords).select("doc_id", "cleaned")


def word_freq(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(_documents(spark, folder).select("text"))
    return ops.word_frequency(documents, "text", ENGLISH)


def word_freq_joined_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    """The stopwords are a table: every word of the benchmark items."""
    items = table(spark, folder, "benchmark")
    stopwords = ops.explode_words(items, "text").distinct()
    documents = spread(_documents(spark, folder).select("text"))
    return ops.word_frequency(documents, "text", stopwords, 50)


def count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder).withColumnRenamed("lang", "category")
    return ops.count_by(documents, "category").orderBy("category")


def count_by_aspect(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder).withColumnRenamed("source", "aspect")
    return ops.count_by(documents, "aspect").orderBy("aspect")


def aspect_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return ops.aspect_sentiment(_reviews(_documents(spark, folder), folder))


def aspect_extremes(spark: SparkSession, folder: str) -> DataFrame:
    return ops.aspect_extremes(_reviews(_documents(spark, folder), folder))


def top5_words_class(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(_documents(spark, folder).select("doc_id", "text", "lang"))
    reviews = ops.with_sentiment(_reviews(documents, folder))
    return ops.top_words(reviews, ["category", "sentiment"], "comment", ENGLISH)


def top5_words_class_line(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_words_line(top5_words_class(spark, folder), ["category", "sentiment"])


def top5_words_category(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(_documents(spark, folder).select(F.col("lang").alias("category"), "text"))
    return ops.top_words(documents, ["category"], "text", ENGLISH)


def top5_words_category_line(spark: SparkSession, folder: str) -> DataFrame:
    return ops.top_words_line(top5_words_category(spark, folder), ["category"])


_STOP = ", ".join(f"'{word}'" for word in ENGLISH)
_WORDS = r"regexp_split_to_array(lower({text}), '[^\p{{L}}0-9]+')"
_COUNTABLE = "(length(word) > 1 OR strlen(word) > 3)"
_COUNTED = f"{_COUNTABLE} AND word NOT IN ({_STOP})"
_REVIEWS = """
  SELECT d.text AS comment, d.lang AS aspect, d.lang AS category,
         CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment
  FROM documents d JOIN labels l USING (doc_id)"""


def _top_words(source: str, text: str, classes: str) -> str:
    words = _WORDS.format(text=text)
    return f"""
      WITH counts AS (
        SELECT {classes}, word, count(*) AS n
        FROM (SELECT {classes}, unnest({words}) AS word FROM ({source}))
        WHERE {_COUNTED} GROUP BY {classes}, word)
      SELECT {classes}, word, n, CAST(rank AS INTEGER) AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY {classes} ORDER BY n DESC, word) AS rank
        FROM counts)
      WHERE rank <= 5"""


def _top_lines(top: str, classes: str) -> str:
    return f"""
      SELECT {classes}, string_agg(word || '=' || n, ', ' ORDER BY rank) AS top_words
      FROM ({top}) GROUP BY {classes}"""


_CLASS = _top_words(_REVIEWS, "comment", "category, sentiment")
_CATEGORY = _top_words("SELECT lang AS category, text FROM documents", "text", "category")

QUERIES = {
    "clean_text": clean_text,
    "clean_text_joined_stopwords": clean_text_joined_stopwords,
    "word_freq": word_freq,
    "word_freq_joined_stopwords": word_freq_joined_stopwords,
    "count_by_category": count_by_category,
    "count_by_aspect": count_by_aspect,
    "aspect_sentiment": aspect_sentiment,
    "aspect_extremes": aspect_extremes,
    "top5_words_class": top5_words_class,
    "top5_words_class_line": top5_words_class_line,
    "top5_words_category": top5_words_category,
    "top5_words_category_line": top5_words_category_line,
}



def _cleaned(kept: str) -> str:
    """Texts of the words `w` that fulfil a condition."""
    return rf"""
      SELECT doc_id, cleaned FROM (
        SELECT doc_id, regexp_replace(array_to_string(list_filter(
            regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'),
            lambda w: w <> '' AND {kept}), ' '),
          '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS cleaned
        FROM documents)
      WHERE length(cleaned) > 0"""


SQL = {
    "clean_text": _cleaned(f"w NOT IN ({_STOP})"),
    "clean_text_joined_stopwords": _cleaned("substr(w, 1, 1) NOT IN ('a', 'e', 'i', 'o', 'u')"),
    "word_freq": f"""
      SELECT word, count(*) AS n
      FROM (SELECT unnest({_WORDS.format(text="text")}) AS word FROM documents)
      WHERE {_COUNTED} GROUP BY word HAVING count(*) > 500""",
    "word_freq_joined_stopwords": f"""
      SELECT word, count(*) AS n
      FROM (SELECT unnest({_WORDS.format(text="text")}) AS word FROM documents)
      WHERE {_COUNTABLE} AND word NOT IN (
        SELECT unnest({_WORDS.format(text="text")}) FROM benchmark)
      GROUP BY word HAVING count(*) > 50""",
    "count_by_category": """
      SELECT lang AS category, count(*) AS n FROM documents
      WHERE length(lang) > 0 GROUP BY lang ORDER BY 1""",
    "count_by_aspect": """
      SELECT source AS aspect, count(*) AS n FROM documents
      WHERE length(source) > 0 GROUP BY source ORDER BY 1""",
    "aspect_sentiment": f"""
      SELECT aspect, sentiment, count(*) AS n FROM ({_REVIEWS})
      WHERE length(aspect) > 0 GROUP BY aspect, sentiment""",
    "aspect_extremes": f"""
      SELECT sentiment, aspect, n FROM (
        SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, aspect) AS place
        FROM (SELECT aspect, sentiment, count(*) AS n FROM ({_REVIEWS})
              WHERE length(aspect) > 0 GROUP BY aspect, sentiment))
      WHERE place = 1""",
    "top5_words_class": _CLASS,
    "top5_words_class_line": _top_lines(_CLASS, "category, sentiment"),
    "top5_words_category": _CATEGORY,
    "top5_words_category_line": _top_lines(_CATEGORY, "category"),
}
