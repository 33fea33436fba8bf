from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from thermoloom.session import build_session  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw readings from (noted_date, temp, place[, id[, source]]) tuples."""

    def make(*rows):
        full = []
        for n, row in enumerate(rows):
            date, temp, place, *rest = row
            number = rest[0] if rest else f"__export__.temp_log_{n}_x"
            source = rest[1] if len(rest) > 1 else "s"
            full.append((number, "Room", date, float(temp), place, source))
        return spark.createDataFrame(
            full,
            "id string, `room_id/id` string, noted_date string, temp double, `out/in` string, source string",
        )

    return make
