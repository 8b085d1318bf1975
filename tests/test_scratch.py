"""Intermediate tables are gone once their owner is done."""

from pathlib import Path

from helpers import feed_of

from feedloom import scratch
from feedloom.operators.intake import valid_records
from feedloom.operators.ordering import sorted_by


def test_release_removes_tables(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_given", [])
    stored = sorted_by(valid_records(feed_of(spark, ["2,a,b,c", "1,a,b,c"])), "id")
    assert [r["id"] for r in stored.orderBy("pos").collect()] == [1, 2]
    made = [Path(path.removeprefix("file:")) for path in scratch._given]
    assert made and all(path.exists() for path in made)
    scratch.release(spark)
    assert not any(path.exists() for path in made) and not scratch._given
