from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

US, RS = "\x1f", "\x1e"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("feedlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def framed(titles, types, rows, tail="\n", newline="\n") -> str:
    records = [US.join(titles), US.join(types), "", ""] + [
        r if isinstance(r, str) else US.join(r) for r in rows
    ]
    return (RS + newline).join(records) + RS + tail


class Landing:
    """A landing tree ``…/data/{org}/feed/finished/{date}/{file}``."""

    def __init__(self, root: Path):
        self.root = root

    def put(self, org, date, name, content) -> Path:
        path = self.root / "data" / org / "feed" / "finished" / date / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return path

    def entity(self, org, date, entity, titles, types, rows, stamp="20150901090417", **kw) -> Path:
        name = f"{entity}_4.0_{stamp}_{org}.asv"
        return self.put(org, date, name, framed(titles, types, rows, **kw))

    def manifest(self, org, date, rows) -> Path:
        return self.put(
            org,
            date,
            f"Manifest_4.0_{org}.asv",
            framed(["File", "Rows", "Hash", "Time"], ["V", "NUMBER", "V", "V"], rows),
        )

    def control(self, org, date, job) -> Path:
        return self.put(org, date, "CONTROL.TXT", f"{org}~{date}~{date}~{job}~/data/{org}/x\n")

    @property
    def source(self) -> str:
        return str(self.root / "data" / "*" / "feed" / "finished")


@pytest.fixture
def landing(tmp_path_factory):
    return Landing(Path(tempfile.mkdtemp(prefix="run-", dir="/tmp")))


@pytest.fixture
def golden(spark):
    return spark.createDataFrame(
        [
            ("allergy", 1, "patient_id", None),
            ("allergy", 2, "allergy_name", None),
            ("allergy", 3, "allergy_code", None),
            ("patient", 1, "patient_id", None),
            ("patient", 2, "ssn", "remove"),
            ("patient", 3, "city", None),
        ],
        "entity string, column_id long, column_name string, comment string",
    )


@pytest.fixture
def lists(spark):
    from feedlake.plans.ingest import AllowLists

    return AllowLists(
        divisions=spark.createDataFrame([("2208",), ("2209",)], "org_id string"),
        practices=spark.createDataFrame([("416",), ("1267",), ("AB1",)], "practice_id string"),
        entities=spark.createDataFrame(
            [("ALLERGY",), ("PATIENT",), ("CHART",), ("MANIFEST",)], "entity string"
        ),
    )
