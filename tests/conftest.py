"""One local session per test run, with its own warehouse and shared folder."""

from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from gridmetrics.session import local_session  # noqa: E402

NAMESPACES = ("bronze", "silver", "gold", "ops")


@pytest.fixture(scope="session")
def spark():
    base = tempfile.mkdtemp(prefix="gridmetrics-")
    session = local_session(
        4,
        **{
            "spark.sql.warehouse.dir": f"{base}/warehouse",
            "spark.checkpoint.dir": f"{base}/shared",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark):
    """A session whose four namespaces start out absent."""
    for name in NAMESPACES:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    yield spark


@pytest.fixture
def files(spark):
    """Turn ``{file: payload}`` into the ``(file, value)`` frame a scan yields."""

    def build(payloads: dict):
        rows = [
            (name, body if isinstance(body, str) else json.dumps(body, ensure_ascii=False))
            for name, body in payloads.items()
        ]
        return spark.createDataFrame(rows, "file STRING, value STRING")

    return build


def series(title, kind, values, **attributes):
    """One series of an envelope. ``values`` is a list of entries."""
    return {
        "type": title,
        "id": "1",
        "attributes": {"title": title, "type": kind, "color": "#fff", **attributes, "values": values},
    }


def entry(value, moment, percentage=1):
    return {"value": value, "percentage": percentage, "datetime": moment}


def envelope(*included):
    return {"data": {"type": "x", "id": "y", "attributes": {"title": "t"}}, "included": list(included)}


def day(text: str, offset: str = "+01:00") -> str:
    return f"{text}T00:00:00.000{offset}"
