import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from arealens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def force_split(monkeypatch):
    """Treats every table as long and every sample as large, so that hot keys are split even in tests."""
    from arealens import skew

    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    monkeypatch.setattr(skew, "SMALL_SAMPLE", 1)
    monkeypatch.setattr(skew, "SAMPLE_SHARE", 1.0)
    monkeypatch.setattr(skew, "HOT_SPLITS", 9)
    return skew


def rows(df, *columns):
    cols = columns or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=lambda t: tuple((v is None, str(v)) for v in t))
