import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapflow.schemas import BRONZE  # noqa: E402
from snapflow.session import build_session  # noqa: E402

D = dt.datetime


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="snapflow-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="snapflow-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt, "spark.sql.adaptive.coalescePartitions.enabled": "false"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)


def _row(code, arr, bikes, mech, ebike, docks, cap, flags, due, ingested, name="__lower__", due_suffix="+00:00"):
    inst, rent, ret = ("OUI" if f == "y" else "NON" for f in flags)
    if name == "__lower__":
        name = code.lower() if code else None
    return (
        code,
        name,
        arr,
        "75056",
        bikes,
        mech,
        ebike,
        docks,
        cap,
        inst,
        rent,
        ret,
        48.85,
        2.35,
        due.strftime("%Y-%m-%dT%H:%M:%S") + due_suffix,
        ingested,
        ingested.date(),
    )


def golden_rows():
    """The 24-row bronze case of FIXTURES.md (as_of 2024-05-02)."""
    m1, m2 = (2024, 5, 1), (2024, 5, 2)
    r = []
    r.append(_row("A", "Paris", 12, 8, 4, 8, 20, "yyy", D(*m1, 23, 50), D(*m1, 23, 55)))
    r.append(_row("A", "Paris", 10, 6, 4, 10, 20, "yyy", D(*m2, 8, 0, 30), D(*m2, 8, 5)))
    r.append(_row("A", "Paris", 4, 3, 1, 16, 20, "yyy", D(*m2, 8, 10, 10), D(*m2, 8, 15)))
    r.append(_row("B", "Paris", 6, 6, 0, 4, 10, "yyy", D(*m2, 5, 31), D(*m2, 5, 35)))
    r.append(_row("B", "Paris", 1, 1, 0, 9, 10, "yyn", D(*m2, 8, 0), D(*m2, 8, 15)))
    r.append(_row("B2", "Paris", 4, 4, 0, 6, 10, "yyy", D(*m2, 8, 0), D(*m2, 8, 5)))
    r.append(_row("B2", "Paris", 3, 3, 0, 7, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 15)))
    r.append(_row("C", "Paris", 5, 5, 0, 5, 10, "nyy", D(*m2, 8, 10), D(*m2, 8, 15)))
    r.append(_row("D", "Paris", 0, 0, 0, 0, 0, "yyy", D(*m2, 8, 10), D(*m2, 8, 15)))
    r.append(_row(None, "Paris", 1, 1, 0, 9, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 15), name="e"))
    r.append(_row("F", "Paris", 1, 1, 0, 9, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 15), name=None))
    r.append(_row("G", "Issy", 2, 2, 0, 8, 10, "yyy", D(*m2, 7, 0), D(*m2, 7, 0, 30)))
    r.append(_row("G", "Issy", 0, 0, 0, 10, 10, "yyy", D(*m2, 7, 30), D(*m2, 7, 30, 30)))
    r.append(_row("G", "Issy", 0, 0, 0, 10, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 10, 30)))
    r.append(_row("H", "Issy", 2, 2, 0, 8, 10, "yyy", D(*m2, 7, 10), D(*m2, 7, 10, 30)))
    r.append(_row("H", "Issy", 0, 0, 0, 10, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 10, 30)))
    r.append(_row("I", "Issy", 2, 2, 0, 8, 10, "yyy", D(*m1, 20, 0), D(*m1, 20, 5)))
    r.append(_row("I", "Issy", 0, 0, 0, 10, 10, "yyy", D(*m2, 8, 10), D(*m2, 8, 15)))
    r.append(_row("J", "Issy", 3, 3, 0, 7, 10, "yyy", D(*m2, 6, 0), D(*m2, 6, 0, 30)))
    r.append(_row("J", "Issy", 0, 0, 0, 10, 10, "yyy", D(*m2, 7, 5), D(*m2, 7, 5, 30)))
    r.append(_row("J", "Issy", 0, 0, 0, 10, 10, "yny", D(*m2, 8, 10), D(*m2, 8, 10, 30)))
    r.append(_row("K", None, 5, 2, 3, 0, 5, "yyy", D(*m2, 8, 0), D(*m2, 8, 5)))
    r.append(_row("K", None, 4, 2, 2, 1, 5, "yyy", D(*m2, 8, 0), D(*m2, 8, 15)))
    r.append(_row("M", None, 7, 0, 7, 0, 7, "yyy", D(*m2, 8, 0), D(*m2, 8, 15), due_suffix="+02:00"))
    return r


@pytest.fixture()
def golden_bronze(spark):
    return spark.createDataFrame(golden_rows(), BRONZE)


AS_OF = dt.date(2024, 5, 2)
