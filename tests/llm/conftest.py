import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame as a table on disk, as the queries read it."""

    def make(rows, schema, folder, files=2):
        df = spark.createDataFrame(rows, schema)
        df.repartition(files).write.parquet(str(folder))
        return spark.read.parquet(str(folder))

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(frame, tmp_path_factory):
    """A table of documents from (doc_id, text) pairs."""

    def make(pairs, files=2):
        rows = [
            (i, t, "en", "s", None if t is None else len(t)) for i, t in pairs
        ]
        return frame(rows, DOCS, tmp_path_factory.mktemp("docs") / "t", files)

    return make
