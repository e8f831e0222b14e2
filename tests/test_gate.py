"""Polls of a landing tree: what is ready, late, failed or missing, and that it is loaded once."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from test_loads import A_TITLES, A_TYPES

from feedlake.streaming import gate
from feedlake.streaming.gate import Patience, landed, ledger_of, poll_directories, poll_manifests

US = "\x1f"
DAY = "2015-09-01"


def rows(spark, out):
    found = landed(spark, out).where("verdict = 'ok'").collect()
    return sorted((r["org_id"], r["line"].split(US)[0], r["job_id"]) for r in found)


def events(spark, out, about):
    found = ledger_of(spark, out).events().where(f"about = '{about}'").collect()
    return sorted((r["state"], r["subject"].split("/data/")[1]) for r in found)


@pytest.fixture
def poll(spark, landing, golden, lists, tmp_path):
    def run(way=poll_directories, hours=0, **patience):
        now = datetime.now(timezone.utc) + timedelta(hours=hours)
        return way(spark, f"{landing.source}/2015*", lists, golden, str(tmp_path / "out"), patience=Patience(**patience), now=now)

    return run


def put(landing, org, *ids, date=DAY, **kw):
    return landing.entity(org, date, "allergy", A_TITLES, A_TYPES, [[i, "n", "1"] for i in ids], **kw)


def test_three_polls(spark, landing, poll, tmp_path):
    out = str(tmp_path / "out")
    put(landing, "416", "1")
    landing.control("416", DAY, "J1")
    put(landing, "1267", "2")
    put(landing, "AB1", "3")
    landing.put("AB1", DAY, "_FAILURE", "")
    assert rows(spark, out) == []
    assert len(poll()) == 1
    assert rows(spark, out) == [("416", "1", "J1")]
    assert events(spark, out, "note") == [("failed", f"AB1/feed/finished/{DAY}/")]
    assert poll(hours=3) == []  # the directory without a control file is late now, which is noted once
    assert poll(hours=4) == []
    late = ("late", f"1267/feed/finished/{DAY}/")
    assert events(spark, out, "note") == [("failed", f"AB1/feed/finished/{DAY}/"), late]
    (landing.root / "data/AB1/feed/finished" / DAY / "_FAILURE").unlink()
    landing.put("AB1", DAY, "control.txt", f"AB1~{DAY}~{DAY}~J3~/x\n")  # a name in lower case
    landing.control("1267", DAY, "J2")
    assert len(poll(hours=5)) == 1
    assert rows(spark, out) == [("1267", "2", "J2"), ("416", "1", "J1"), ("AB1", "3", "J3")]
    assert poll(hours=6) == []


def test_markers_and_changed_directories(spark, landing, poll, tmp_path):
    out = str(tmp_path / "out")
    put(landing, "416", "1")
    landing.control("416", DAY, "J1")
    marker = landing.put("416", DAY, "working.txt", "")
    assert poll() == []
    marker.unlink()
    assert len(poll()) == 1
    put(landing, "416", "2", stamp="20150901090418")  # comes after the load
    assert len(poll()) == 1
    assert rows(spark, out) == [("416", "1", "J1"), ("416", "2", "J1")]
    (landing.root / "data/416/feed/finished" / DAY / "CONTROL.TXT").unlink()
    assert poll(hours=9) == []  # what was loaded stays
    assert rows(spark, out) == [("416", "1", "J1"), ("416", "2", "J1")]


def test_portions(spark, landing, poll, tmp_path):
    for n, org in enumerate(("416", "1267", "AB1")):
        for date in (DAY, "2015-09-02"):
            put(landing, org, f"{n}", date=date)
            landing.control(org, date, "J")
    assert len(poll(at_once=4)) == 2
    assert len(rows(spark, str(tmp_path / "out"))) == 6


def test_a_load_that_fails_or_is_killed(spark, landing, poll, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    put(landing, "416", "1")
    landing.control("416", DAY, "J1")
    land = gate._land

    def partly(*args):
        land(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(gate, "_land", partly)
        with pytest.raises(RuntimeError):
            poll()
    assert rows(spark, out) == []  # written, but not committed
    assert len(poll()) == 1  # given back
    put(landing, "1267", "2")
    landing.control("1267", DAY, "J2")

    def killed(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(gate, "_land", killed)
        with pytest.raises(KeyboardInterrupt):
            poll()
    assert poll(hours=5) == []  # someone may still be at it
    assert len(poll(hours=7)) == 1
    assert rows(spark, out) == [("1267", "2", "J2"), ("416", "1", "J1")]


def test_manifests(spark, landing, poll, tmp_path):
    out = str(tmp_path / "out")
    name = "allergy_4.0_20150901090417_{}.asv"
    put(landing, "416", "1")
    landing.manifest("2208", DAY, [[name.format("416"), "1", "h", "t"], [name.format("1267"), "1", "h", "t"]])
    landing.manifest("2209", DAY, [[name.format("416"), "1", "h", "t"]])  # names the same file
    assert poll(poll_manifests) == []  # no control file yet
    landing.control("2208", DAY, "D")
    landing.control("2209", DAY, "D")
    landing.control("416", DAY, "J1")
    assert len(poll(poll_manifests)) == 1
    assert rows(spark, out) == [("416", "1", "J1")]
    assert events(spark, out, "note") == []
    assert poll(poll_manifests, hours=3) == []
    assert poll(poll_manifests, hours=3) == []
    assert events(spark, out, "note") == [("missing", f"1267/feed/finished/{DAY}/" + name.format("1267"))]
    put(landing, "1267", "2")  # comes after it was missed
    assert len(poll(poll_manifests, hours=4)) == 1
    assert rows(spark, out) == [("1267", "2", ""), ("416", "1", "J1")]
    assert poll(poll_manifests, hours=5) == []
