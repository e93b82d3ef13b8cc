from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from novalake.schemas import ALERT, CANDIDATE, FORCED, HISTORY  # noqa: E402
from novalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", 8, {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.log.level": "ERROR",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
    })
    yield session
    session.stop()


def _values(schema, given):
    unknown = set(given) - set(schema.names)
    assert not unknown, unknown
    return tuple(given.get(n) for n in schema.names)


def history(**fields):
    """One element of prv_candidates."""
    return _values(HISTORY, {"jd": 2460310.75, "fid": 1, "pid": 5, "magpsf": 17.0, "sigmapsf": 0.1} | fields)


def forced(**fields):
    """One usable element of fp_hists."""
    return _values(FORCED, {
        "procstatus": "0", "jd": 2460310.75, "fid": 1, "pid": 5, "rfid": 11, "ranr": 10.0,
        "decnr": 20.0, "magzpsci": 26.0, "forcediffimflux": 100.0, "forcediffimfluxunc": 10.0,
        "distnr": 0.5, "magnr": 18.0, "sigmagnr": 0.1, "chinr": 1.0, "sharpnr": 0.1,
    } | fields)


def alert(candid, obj="A", date="2024-01-01", prv=None, fp=None, **candidate):
    base = {"candid": candid, "jd": 2460310.75, "fid": 1, "pid": 5, "rfid": 11, "magpsf": 17.0,
            "sigmapsf": 0.1, "magnr": 16.0, "sigmagnr": 0.2, "distnr": 0.5, "isdiffpos": "t",
            "jdstartref": 2459000.5, "jdendref": 2459200.5, "nframesref": 15}
    return (obj, candid, _values(CANDIDATE, base | candidate), prv, fp, dt.date.fromisoformat(date))


@pytest.fixture
def alerts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), ALERT)
