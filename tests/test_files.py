import json
import subprocess
import sys

import pytest
from helpers import lines, rows
from test_ratings import ITEMS, OCCUPATIONS, RATINGS, USERS
from test_sales import CUSTOMERS, ITEMS as ORDER_ITEMS, ORDERS, PRODUCTS, REVIEWS
from test_text import REVIEWS as COMMENTS
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge import jobs
from tallyforge.operators.keyed import numbered, rank_by
from tallyforge.plans import files as files_plan
from tallyforge.session import materialise, new_run_folder, shared_folder
from tallyforge.sinks import files, reports
from tallyforge.streaming import stats, store


def text(spark, path):
    return sorted(r.value for r in spark.read.text(str(path)).collect())


def test_tsv(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ('a "x', 1)], "k string, n int").coalesce(1)
    files.write_tsv(df, str(tmp_path / "out"), sort_by=["k"])
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == 'a "x\t1\nb\t2\n'


def test_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    files.write_csv(df, str(tmp_path / "csv"))
    again = spark.read.option("header", True).schema(df.schema).csv(str(tmp_path / "csv"))
    assert rows(again) == rows(df)
    files.write_parquet(df, str(tmp_path / "parquet"), "k")
    assert rows(spark.read.parquet(str(tmp_path / "parquet")).select("k", "n")) == rows(df)


def test_preview(spark, capsys):
    files.preview(spark.range(30), 10)
    assert "top 10 rows" in capsys.readouterr().out


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert not named or shared_folder(spark) == named
    assert new_run_folder(spark, "x") != new_run_folder(spark, "x")
    assert rows(materialise(spark.range(3))) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("range_rows", [1, 2, 5, 256])
def test_rank_with_ties_and_nulls(spark, range_rows):
    values = [(i, float(v) if v is not None else None) for i, v in
              enumerate([5, 5, 5, 1, None, 9, 9, 2, 0, -3, None, 5])]
    df = spark.createDataFrame(values, "id int, v double")
    found = rank_by(df, {"place": "v"}, range_rows).select("id", "place")
    known = [v for _, v in values if v is not None]
    expected = [(i, 1 + (len(known) if v is None else sum(k > v for k in known)))
                for i, v in values]
    assert rows(found) == sorted(expected, key=repr)


def test_ranges_grow_with_the_rows(spark):
    df = spark.range(2000).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("v"), "id")
    whole = rows(rank_by(df, {"place": "v"}))
    # Twice two and twenty ranges
    for range_rows in (1000, 100):
        assert rows(rank_by(df, {"place": "v"}, range_rows)) == whole
    assert rows(numbered(df, [F.desc("v"), F.asc("id")], "n", 50).select("id", "n")) == rows(
        df.withColumn("n", F.row_number().over(Window.orderBy(F.desc("v"), "id"))).select("id", "n")
    )


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("jobs")
    for name, content in {
        "comments": COMMENTS, "ratings": RATINGS, "items": ITEMS, "users": USERS,
        "occupations": OCCUPATIONS,
    }.items():
        (path / name).write_text("\n".join(content) + "\n", encoding="utf-8")
    for name, content in {"orders": ORDERS, "customers": CUSTOMERS, "order-items": ORDER_ITEMS,
                          "products": PRODUCTS, "order-reviews": REVIEWS}.items():
        (path / name).write_text(content, encoding="utf-8")
    record = {"frame_id": "f", "timestamp": 1.0, "camera_id": "a", "person_count": 2,
              "bounding_boxes": [{"x1": 1, "y1": 1, "x2": 2, "y2": 2, "confidence": 0.5}]}
    checked = store.check_detections(lines(spark, json.dumps(record)))
    store.store_batch(
        store.good_detections(checked), "w", 0, str(path / "events"), str(path / "boxes")
    )
    return path


@pytest.mark.parametrize("job", sorted(jobs.JOBS))
def test_job(spark, folder, tmp_path, job):
    sources = ["--reviews", str(folder / "comments"), "--min-count", "1", "--min-ratings", "1"]
    for name in ("ratings", "items", "users", "occupations", "orders", "customers",
                 "order-items", "products", "order-reviews", "events", "boxes"):
        sources += [f"--{name}", str(folder / name)]
    jobs.run(spark, [job, "--out", str(tmp_path / "out"), *sources])
    assert text(spark, tmp_path / "out")


def test_job_results(spark, folder, tmp_path):
    comments = ["--reviews", str(folder / "comments")]
    jobs.run(spark, ["categories", "--out", str(tmp_path / "a"), *comments])
    assert text(spark, tmp_path / "a") == ["HOTEL\t4", "ROOMS\t2"]
    jobs.run(spark, ["top-words", "--out", str(tmp_path / "b"), "--top", "1", *comments])
    assert "ROOMS\tphòng=2" in text(spark, tmp_path / "b")
    jobs.run(spark, ["years", "--out", str(tmp_path / "c"), "--format", "report",
                     "--ratings", str(folder / "ratings")])
    lines_of = [r.value for r in spark.read.text(str(tmp_path / "c")).collect()]
    assert lines_of[:3] == list(reports.YEAR_HEAD)
    assert lines_of[3] == "2020       | 4.25            | 4"
    with pytest.raises(SystemExit):
        jobs.parse(["categories", "--out", "x", "--format", "report"])


def test_jobs_start_as_a_program():
    shown = subprocess.run([sys.executable, "-m", "tallyforge.jobs", "--help"],
                           capture_output=True, text=True, timeout=120, check=True)
    assert "word-frequency" in shown.stdout


def test_tsv_keeps_values(spark, tmp_path):
    from tallyforge.sinks.files import write_tsv

    df = spark.createDataFrame([("  lead", "a\tb"), ("x\ny", ""), ("q\\t", None)], "k string, v string")
    write_tsv(df.coalesce(1), str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == ["  lead\ta\\tb", "x\\ny\t", "q\\\\t\t"]


def test_csv_keeps_spaces_and_quotes(spark, tmp_path):
    from tallyforge.sinks.files import write_csv

    given = [("  a ", 'say "x", y')]
    write_csv(spark.createDataFrame(given, "k string, v string"), str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == given


def test_streaming_hops_as_jobs(spark, tmp_path, monkeypatch):
    import base64

    (tmp_path / "detector.py").write_text(
        "def load():\n    return lambda pictures: [[dict(x1=0, y1=0, x2=len(p), y2=1, confidence=0.9,"
        " class_id=0)] for p in pictures]\n"
    )
    monkeypatch.syspath_prepend(str(tmp_path))
    # As with --py-files
    spark.sparkContext.addPyFile(str(tmp_path / "detector.py"))
    (tmp_path / "inbox").mkdir()
    frame = {"frame_id": "f", "timestamp": 60.5, "camera_id": "c", "frame_b64": base64.b64encode(b"abc").decode()}
    (tmp_path / "inbox" / "1.json").write_text(json.dumps(frame) + "\n{broken\n")

    def hop(job, inbox, *more):
        jobs.run(spark, [job, "--inbox", str(tmp_path / inbox), "--out", str(tmp_path / f"{job}-out"),
                         "--rejects", str(tmp_path / f"{job}-bad"), "--checkpoint", str(tmp_path / f"{job}-check"), *more])

    hop("stream-ingest", "inbox")
    hop("stream-detect", "stream-ingest-out", "--detector", "detector:load", "--list-size", "4")
    hop("stream-store", "stream-detect-out/*", "--boxes", str(tmp_path / "boxes"), "--max-files", "1")
    hop("stream-minutes", "stream-detect-out/*")
    events = ["--events", str(tmp_path / "stream-store-out"), "--boxes", str(tmp_path / "boxes")]
    jobs.run(spark, ["boxes", "--out", str(tmp_path / "b"), "--frame", "f", *events])
    assert text(spark, tmp_path / "b") == ["f\t0\t0\t3\t1\t0.9"]
    jobs.run(spark, ["recent", "--out", str(tmp_path / "r"), *events])
    assert text(spark, tmp_path / "r")[0].startswith("f\tc\t1970-01-01 00:01:00.5\t1")
    assert stats.read_minutes(spark, str(tmp_path / "stream-minutes-out")).count() == 1
    assert spark.read.parquet(str(tmp_path / "stream-ingest-bad")).count() == 1


REPORTS = {
    "items": [
        "========== DANH SÁCH PHIM ==========",
        "MovieID: a | Title: The Good, the Bad (1966) | Average Rating: 4.3 | Total Ratings: 5",
        "MovieID: b | Title: Title (2000) | Average Rating: 3.0 | Total Ratings: 4",
        "MovieID: c | Title: " + "A" * 38 + " | Average Rating: 4.0 | Total Ratings: 1",
        "",
        "========== TOP MOVIE ==========",
        "Phim có điểm cao nhất : The Good, the Bad (1966)",
        "Điểm trung bình       : 4.3",
    ],
    "labels": [
        "========== ĐIỂM TRUNG BÌNH THEO THỂ LOẠI ==========",
        "THỂ LOẠI             | ĐIỂM TRUNG BÌNH",
        "---------------------------------------------------",
        "Western              | 4.30",
        "War                  | 4.25",
        "Drama                | 4.00",
        "Unknown              | 3.00",
    ],
    "genders": [
        "========== ĐÁNH GIÁ PHIM THEO GIỚI TÍNH ==========",
        "MovieID    | TITLE                                    | GENDER     | AVG RATING",
        "----------------------------------------------------------------------------------",
        "a          | The Good, the Bad (1966)                 | Nữ         | 4.25",
        "a          | The Good, the Bad (1966)                 | Nam        | 5.00",
        "a          | The Good, the Bad (1966)                 | Nữ         | 3.00",
        "b          | Title (2000)                             | Nữ         | 1.00",
        "b          | Title (2000)                             | Nam        | 3.00",
        "c          | " + "A" * 35 + "...   | Nữ         | 4.00",
    ],
    "ages": [
        "========== ĐÁNH GIÁ PHIM THEO NHÓM TUỔI ==========",
        "MovieID    | TITLE                               | AGE GROUP    | AVG RATING",
        "----------------------------------------------------------------------------------",
        "a          | The Good, the Bad (1966)            | 36-50        | 4.25",
        "a          | The Good, the Bad (1966)            | 51+          | 3.00",
        "a          | The Good, the Bad (1966)            | <18          | 5.00",
        "b          | Title (2000)                        | 36-50        | 1.00",
        "b          | Title (2000)                        | <18          | 3.00",
        "c          | " + "A" * 30 + "...   | 51+          | 4.00",
    ],
    "occupations": [
        "========== ĐÁNH GIÁ TRUNG BÌNH THEO NGHỀ NGHIỆP ==========",
        "NGHỀ NGHIỆP               | ĐIỂM TRUNG BÌNH | TỔNG SỐ LƯỢT ĐÁNH GIÁ",
        "----------------------------------------------------------------------",
        "Cook                      | 3.43            | 7",
        "Clerk                     | 3.17            | 3",
    ],
    "years": [
        "========== ĐÁNH GIÁ TRUNG BÌNH THEO TỪNG NĂM ==========",
        "NĂM        | ĐIỂM TRUNG BÌNH | TỔNG SỐ LƯỢT ĐÁNH GIÁ",
        "----------------------------------------------------------------",
        "2020       | 4.25            | 4",
        "2021       | 3.07            | 7",
    ],
}


@pytest.mark.parametrize("job", sorted(REPORTS))
def test_whole_reports(spark, folder, tmp_path, job):
    sources = ["--min-ratings", "1"]
    for name in ("ratings", "items", "users", "occupations"):
        sources += [f"--{name}", str(folder / name)]
    jobs.run(spark, [job, "--format", "report", "--out", str(tmp_path / "out"), *sources])
    parts = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part"))
    found = "".join(p.read_text(encoding="utf-8") for p in parts).split("\n")[:-1]
    assert found == REPORTS[job]


def test_reports_without_rows(spark):
    none = spark.createDataFrame([], "item_id string, title string, avg_rating double, n_ratings long")
    lines_of = reports.LAYOUTS["items"].whole(none)
    assert [r.value for r in lines_of.collect()] == list(reports.ITEM_HEAD)


def test_reviews_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    texts = [(i, f"line {i}", 6) for i in range(100)]
    rows_ = spark.createDataFrame(texts, "doc_id long, text string, n_chars long")
    rows_.write.parquet(f"{tmp_path}/in/documents.parquet")
    monkeypatch.setattr(files_plan, "REVIEWS", 5)
    monkeypatch.setattr(files_plan, "new_run_folder", lambda *_: f"{tmp_path}/out")
    found = files_plan.read_order_reviews(spark, f"{tmp_path}/in")
    assert sorted(int(r.order_id) for r in found.collect()) == list(range(100))
    assert len(found.inputFiles()) == 20
