from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from registry.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"
POSITIONS = (
    "array<struct<summary:string,title:string,start_date:string,end_date:string,"
    "is_current:boolean,company_name:string>>"
)
PROFILE = (
    "pid long, batch long, first_name string, last_name string, num_connections string, "
    f"location string, industry string, skills array<string>, positions {POSITIONS}"
)


@pytest.fixture(scope="session")
def spark():
    return local_session(4)


@pytest.fixture
def profiles(spark):
    """Build profiles from keyword dicts; a position is (start, end) or a dict."""

    def build(*rows):
        def position(p):
            if isinstance(p, dict):
                return tuple(
                    p.get(k)
                    for k in ("summary", "title", "start_date", "end_date", "is_current", "company_name")
                )
            start, end = p
            return ("s", "t", start, end, False, "c")

        data = [
            (
                r.get("pid", i),
                r.get("batch", 0),
                r.get("first_name", f"P{i}"),
                r.get("last_name"),
                r.get("num_connections", "1"),
                r.get("location"),
                r.get("industry"),
                r.get("skills", []),
                [position(p) for p in r.get("positions", [])],
            )
            for i, r in enumerate(rows)
        ]
        return spark.createDataFrame(data, PROFILE)

    return build


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
