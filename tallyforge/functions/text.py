"""Text cleaning and tokenising."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

CONTROLS_AND_SPACE = "".join(map(chr, range(0x21)))


def trim_controls(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends (SQL trim: spaces only)."""
    return F.btrim(text, F.lit(CONTROLS_AND_SPACE))


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits. Combining marks separate words,
    so decomposed text falls apart; the ends may yield empty strings."""
    return F.split(F.lower(text), r"[^\p{L}0-9]+")


def is_countable(word: Column) -> Column:
    """Longer than one UTF-16 unit: two characters, or one beyond the BMP
    (the only single character that takes four bytes)."""
    return (F.length(word) > 1) | (F.octet_length(word) > 3)


def spaced_words(text: Column) -> Column:
    """Lower-cased words between whitespace; the ends may yield empty strings."""
    return F.split(F.lower(text), r"\s+")


def without_stopwords(text: Column, stopwords: Iterable[str]) -> Column:
    """Lower-case, split on whitespace, drop stopwords, rejoin with one space.
    Order and repeats of the kept tokens stay."""
    stop = sorted(set(stopwords) | {""})
    kept = F.filter(spaced_words(text), lambda token: ~token.isin(stop))
    return trim_controls(F.array_join(kept, " "))


def without_words(text: Column, found: Column) -> Column:
    """The same for an array of words of each row; null stands for none. The words of a row are
    looked up in a set, as an array is searched through for every word of the text."""

    # Local, so that it travels to the workers by value
    @F.pandas_udf("string")
    def kept(words: pd.Series, found: pd.Series) -> pd.Series:
        def joined(own, stop):
            if own is None:
                return None
            listed = {""} if stop is None else {"", *stop}
            return " ".join([word for word in own if word not in listed])

        return pd.Series([joined(*row) for row in zip(words, found, strict=True)], dtype=object)

    return trim_controls(kept(spaced_words(text), found))


def shorten(text: Column, limit: int, keep: int) -> Column:
    """Texts longer than `limit` become their first `keep` characters plus `...`."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("..."))
    ).otherwise(text)


def split_labels(text: Column, separator: str = "|") -> Column:
    """Array of trimmed labels. Trailing empty labels are dropped, inner ones stay;
    an empty text is one empty label, a text of separators only has none."""
    bare = F.regexp_replace(text, f"(?:{_quoted(separator)})+$", "")
    labels = F.transform(F.split(bare, _quoted(separator)), trim_controls)
    return F.when((bare == "") & (text != ""), F.array().cast("array<string>")).otherwise(labels)


def _quoted(separator: str) -> str:
    return r"\Q" + separator + r"\E"
