"""The log that several builders append to, and versions entered through it."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from tests.fixture_data import fixture_raw
from tillwise.config import AnalyticsConfig
from tillwise.plans.pipeline import build_tables
from tillwise.sources import commits
from tillwise.sources.files import located
from tillwise.sources.tables import VERSION_LOG, current_version, drop_old_versions, new_version, publish, read_tables


def test_entries_are_numbered_and_whole(spark, tmp_path):
    log = f"{tmp_path}/log"
    assert commits.numbers(spark, log) == []
    assert [commits.append(spark, log, text) for text in ("one", "zwö", "")] == [1, 2, 3]
    assert [commits.read(spark, log, n) for n in commits.numbers(spark, log)] == ["one", "zwö", ""]
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")) == [f"{n:019d}" for n in (1, 2, 3)]


def test_nothing_is_replaced(spark, tmp_path):
    path = f"{tmp_path}/log/{1:019d}"
    assert commits.create(spark, path, "first") and not commits.create(spark, path, "second")
    assert commits.read(spark, f"{tmp_path}/log", 1) == "first"


def test_rename_never_replaces_either(spark, tmp_path):
    """The way for file systems without links."""
    for name, text in (("a", "first"), ("b", "second")):
        (tmp_path / name).write_text(text)
    a, b, place = (located(spark, f"file:{tmp_path}/{name}")[0] for name in ("a", "b", "place"))
    assert commits._renamed(spark, a, place)
    assert not commits._renamed(spark, b, place)
    assert (tmp_path / "place").read_text() == "first" and (tmp_path / "b").exists()


def test_two_interleaved_publishes(spark, tmp_path, monkeypatch):
    """Both builders look before either enters its version: two numbers, one current version."""
    folder, late, early = str(tmp_path), f"{tmp_path}/tables-late", f"{tmp_path}/tables-early"
    seen = []
    original = commits.numbers

    def overtaken(spark, log):
        found = original(spark, log)
        if not seen:  # the other builder enters its version right after this look
            seen.append(found)
            assert publish(spark, folder, early) == 1
        return found

    monkeypatch.setattr(commits, "numbers", overtaken)
    assert publish(spark, folder, late) == 2
    assert original(spark, f"{folder}/{VERSION_LOG}") == [1, 2]
    assert {current_version(spark, folder) for _ in range(3)} == {late}


def test_many_writers_lose_nothing(spark, tmp_path):
    log = f"{tmp_path}/log"
    with ThreadPoolExecutor(8) as pool:
        given = list(pool.map(lambda k: (commits.append(spark, log, f"w{k}"), f"w{k}"), range(40)))
    assert sorted(n for n, _ in given) == list(range(1, 41))
    assert all(commits.read(spark, log, n) == text for n, text in given)


def test_builds_that_end_together_leave_one_current_version(spark, tmp_path):
    folder = str(tmp_path / "tables")
    raw = fixture_raw(spark)
    few = raw.filter("customer_id IS NULL OR customer_id <> 12347")
    with ThreadPoolExecutor(2) as pool:
        built = list(pool.map(lambda r: build_tables(r, folder, AnalyticsConfig(), str(tmp_path / "staging")).orders.count(), (raw, few)))
    assert commits.numbers(spark, f"{folder}/{VERSION_LOG}") == [1, 2]
    current = current_version(spark, folder)
    assert read_tables(spark, folder).orders.count() in built
    drop_old_versions(spark, folder)
    assert current_version(spark, folder) == current and [p.name for p in (tmp_path / "tables").glob("tables-*")] == [current.rsplit("/", 1)[-1]]


def test_a_folder_without_tables_says_so(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        current_version(spark, str(tmp_path))
    assert new_version(str(tmp_path)).startswith(f"{tmp_path}/tables-")
