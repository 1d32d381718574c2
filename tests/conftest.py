from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.plans.layout import Layout  # noqa: E402
from tidemark.session import local_session  # noqa: E402

START = datetime(2025, 4, 18, 9, 30, 0)
END = datetime(2025, 4, 18, 9, 31, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(
        "tidemark-tests",
        8,
        {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": warehouse},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def layout(tmp_path):
    return Layout.below(str(tmp_path))


@pytest.fixture
def landing(tmp_path):
    """Write a landing file, return its path."""
    folder = tmp_path / "files"
    folder.mkdir()

    def write(name: str, *lines: str) -> str:
        path = folder / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def ansi(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.ansi.enabled")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda row: [(v is None, str(v)) for v in row])
