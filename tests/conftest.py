from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from touchline.session import build_session  # noqa: E402
from verification.fixtures import raw_view  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raw(spark):
    """The four raw sources at the smallest scale, cached."""
    sources = ("matches", "goals", "cards", "match_statistics")
    return {source: raw_view(spark, SF, source).cache() for source in sources}


def values(frame, *columns):
    """Rows as tuples of the given columns, in frame order."""
    return [tuple(row) for row in frame.select(*columns).collect()]


def counted(frame):
    """Rows as a dictionary of check name to count."""
    return {row["check_name"]: row["invalid_count"] for row in frame.collect()}
