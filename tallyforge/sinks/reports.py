"""Fixed-width text reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.labels import gender_name
from tallyforge.functions.text import shorten

# Row formats of the rating reports
ITEM_ROW = "MovieID: %s | Title: %s | Average Rating: %s | Total Ratings: %d"
GENRE_ROW = "%-20s | %.2f"
GENDER_ROW = "%-10s | %-40s | %-10s | %.2f"
AGE_ROW = "%-10s | %-35s | %-12s | %.2f"
OCCUPATION_ROW = "%-25s | %-15.2f | %d"
YEAR_ROW = "%-10s | %-15.2f | %d"

# Banner, header row and rule of each report, and the closing lines of the items
ITEM_HEAD = ("========== DANH SÁCH PHIM ==========",)
GENRE_HEAD = (
    "========== ĐIỂM TRUNG BÌNH THEO THỂ LOẠI ==========",
    "THỂ LOẠI             | ĐIỂM TRUNG BÌNH",
    "---------------------------------------------------",
)
GENDER_HEAD = (
    "========== ĐÁNH GIÁ PHIM THEO GIỚI TÍNH ==========",
    "MovieID    | TITLE                                    | GENDER     | AVG RATING",
    "----------------------------------------------------------------------------------",
)
AGE_HEAD = (
    "========== ĐÁNH GIÁ PHIM THEO NHÓM TUỔI ==========",
    "MovieID    | TITLE                               | AGE GROUP    | AVG RATING",
    "----------------------------------------------------------------------------------",
)
OCCUPATION_HEAD = (
    "========== ĐÁNH GIÁ TRUNG BÌNH THEO NGHỀ NGHIỆP ==========",
    "NGHỀ NGHIỆP               | ĐIỂM TRUNG BÌNH | TỔNG SỐ LƯỢT ĐÁNH GIÁ",
    "----------------------------------------------------------------------",
)
YEAR_HEAD = (
    "========== ĐÁNH GIÁ TRUNG BÌNH THEO TỪNG NĂM ==========",
    "NĂM        | ĐIỂM TRUNG BÌNH | TỔNG SỐ LƯỢT ĐÁNH GIÁ",
    "----------------------------------------------------------------",
)
TOP_HEAD = ("", "========== TOP MOVIE ==========")
TOP_TITLE = "Phim có điểm cao nhất : %s"
TOP_AVERAGE = "Điểm trung bình       : %s"


def item_row() -> Column:
    """Averages in full precision, one line per item."""
    average = F.col("avg_rating").cast("string")
    return F.format_string(ITEM_ROW, F.col("item_id").cast("string"), "title", average, "n_ratings")


def label_row() -> Column:
    return F.format_string(GENRE_ROW, "label", "avg_rating")


def gender_row() -> Column:
    title = shorten(F.col("title"), 37, 35)
    gender = gender_name(F.col("gender"))
    item = F.col("item_id").cast("string")
    return F.format_string(GENDER_ROW, item, title, gender, "avg_rating")


def age_row() -> Column:
    title = shorten(F.col("title"), 32, 30)
    item = F.col("item_id").cast("string")
    return F.format_string(AGE_ROW, item, title, "age_band", "avg_rating")


def occupation_row() -> Column:
    return F.format_string(OCCUPATION_ROW, "occupation", "avg_rating", "n_ratings")


def year_row() -> Column:
    return F.format_string(YEAR_ROW, F.col("year").cast("string"), "avg_rating", "n_ratings")


def _rows(row: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    """One text line per row, in the order of the rows."""
    return lambda df: df.select(row().alias("value"))


item_report = _rows(item_row)
label_report = _rows(label_row)
gender_report = _rows(gender_row)
age_report = _rows(age_row)
occupation_report = _rows(occupation_row)
year_report = _rows(year_row)


def _fixed(spark: SparkSession, section: int, lines: Sequence[str]) -> DataFrame:
    both = F.posexplode(F.array(*map(F.lit, lines))).alias("line", "value")
    return spark.range(1).select(F.lit(section).alias("section"), both)


def _top(stats: DataFrame) -> DataFrame:
    """The closing lines: the item of the highest average, on a tie of the smaller title. No
    items, no lines."""
    best = F.min_by(F.struct("title", "avg_rating"), F.struct(-F.col("avg_rating"), "title", "item_id"))
    lines = F.array(
        *map(F.lit, TOP_HEAD),
        F.format_string(TOP_TITLE, "best.title"),
        F.format_string(TOP_AVERAGE, F.col("best.avg_rating").cast("string")),
    )
    found = stats.agg(best.alias("best")).filter("best is not null")
    return found.select(F.lit(2).alias("section"), F.posexplode(lines).alias("line", "value"))


@dataclass(frozen=True)
class Layout:
    """What a whole report is made of: its head, the layout and order of its rows (a minus in
    front of a column means downwards), and whether the best item closes it."""

    head: tuple[str, ...]
    row: Callable[[], Column]
    order: tuple[str, ...]
    top: bool = False

    def lines(self, stats: DataFrame) -> DataFrame:
        """All lines, in any order, as `value`, with the columns that put them in order: `section`,
        `line` within the fixed ones, a key for each column of `order`."""
        keys = [F.col(name.removeprefix("-")).alias(f"key{i}") for i, name in enumerate(self.order)]
        body = stats.select(F.lit(1).alias("section"), *keys, self.row().alias("value"))
        out = _fixed(stats.sparkSession, 0, self.head).unionByName(body, allowMissingColumns=True)
        return out.unionByName(_top(stats), allowMissingColumns=True) if self.top else out

    def by(self) -> list[Column]:
        """The total order of `lines`."""
        keys = [
            F.desc(f"key{i}") if name.startswith("-") else F.asc(f"key{i}")
            for i, name in enumerate(self.order)
        ]
        return [F.asc("section"), F.asc("line"), *keys]

    def whole(self, stats: DataFrame) -> DataFrame:
        """The lines in order, as one column; tasks sort ranges of them, none all."""
        return self.lines(stats).orderBy(*self.by()).select("value")


LAYOUTS = {
    "items": Layout(ITEM_HEAD, item_row, ("item_id",), top=True),
    "labels": Layout(GENRE_HEAD, label_row, ("-avg_rating", "label")),
    "genders": Layout(GENDER_HEAD, gender_row, ("item_id", "gender")),
    "ages": Layout(AGE_HEAD, age_row, ("item_id", "age_band")),
    "occupations": Layout(OCCUPATION_HEAD, occupation_row, ("-avg_rating", "occupation")),
    "years": Layout(YEAR_HEAD, year_row, ("year",)),
}


def write_report(lines: DataFrame, path: str) -> None:
    """The lines to text files, whose names are in the order of the lines."""
    lines.write.text(path)
