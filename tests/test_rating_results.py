"""The six rating reports against published results.

Neither the data nor the results are part of this repository. To run: set RATING_DATA to
the folder of movie, rating, user and occupation files and RATING_RESULTS to that of the
six result files, in the order of their names.
"""

import os
from pathlib import Path

import pytest

from tallyforge import jobs

DATA, RESULTS = os.environ.get("RATING_DATA"), os.environ.get("RATING_RESULTS")
pytestmark = pytest.mark.skipif(not (DATA and RESULTS), reason="no published results given")

JOBS = ("items", "labels", "genders", "ages", "occupations", "years")


@pytest.mark.parametrize("number, job", list(enumerate(JOBS)))
def test_report(spark, tmp_path, number, job):
    paths = {name: [str(p) for p in sorted(Path(DATA).glob(f"{start}*.txt"))]
             for name, start in (("items", "movies"), ("ratings", "ratings"),
                                 ("users", "users"), ("occupations", "occupation"))}
    sources = [part for name, files in paths.items() for part in (f"--{name}", *files)]
    out = str(tmp_path / "out")
    # The published years were counted in a zone west of UTC
    jobs.run(spark, [job, "--out", out, "--format", "report", "--zone", "America/New_York",
                     *sources])
    parts = sorted(p for p in Path(out).iterdir() if p.name.startswith("part"))
    found = "".join(p.read_text(encoding="utf-8") for p in parts).splitlines()
    published = sorted(Path(RESULTS).glob("*.txt"))[number].read_text(encoding="utf-8").splitlines()
    # The published rows come in the order of a hash, and one banner lost its first character
    assert sorted(found[1:]) == sorted(published[1:])
    assert found[0].strip("=") == published[0].strip("=")
