from __future__ import annotations

import sys
from pathlib import Path
from uuid import uuid4

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from martwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(base / "shared"),
        spark__sql__warehouse__dir=str(base / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark):
    """A database of its own for each test."""
    name = f"t{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = []

    def apply(**options):
        for key, value in options.items():
            changed.append(key.replace("__", "."))
            spark.conf.set(changed[-1], value)

    yield apply
    for key in changed:
        spark.conf.unset(key)


def rows(df, *columns):
    """Sorted tuples, for comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
