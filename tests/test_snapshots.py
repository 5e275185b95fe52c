import pytest
from pyspark.errors import AnalysisException

from meterlark import schemas as S
from meterlark.session import fresh_path
from meterlark.sources import files, load
from meterlark.sources.snapshots import Log, Snapshot
from tests.conftest import pairs
from tests.test_load import building, energy, load_all, make


def state(spark, folder, number=None):
    b, e = load.read_loaded(spark, folder, number)
    return pairs(b.select(S.KEY, "city")), pairs(e.select("performance_id", S.KEY, S.YEAR))


def test_a_load_killed_before_its_manifest_changes_nothing(spark, monkeypatch):
    folder = fresh_path(spark, "test-log")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    before = state(spark, folder)

    class Killed(BaseException):
        pass

    def killed(*_):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Log, "publish", killed)
        m.setattr(Log, "remove", lambda *_: None)  # a killed driver does not tidy up
        with pytest.raises(Killed):
            load_all(spark, folder, *make(spark, [building("2")], [energy("2")]))
    log = Log(spark, folder)
    assert state(spark, folder) == before and log.last().number == 1
    assert len(log.unlisted(load.BUILDINGS)) == len(log.unlisted(load.MEASURES)) == 1
    load_all(spark, folder, *make(spark, [building("2", "Later")], [energy("2")]))
    assert state(spark, folder) == ([("1", "Ottawa"), ("2", "Later")], [(1, "1", 2024), (2, "2", 2024)])


def test_of_two_loads_at_once_the_second_begins_again(spark, monkeypatch):
    folder = fresh_path(spark, "test-log")
    load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    publish, calls = Log.publish, []

    def late(log, snapshot):
        calls.append(snapshot.number)
        if len(calls) == 1:  # another load publishes while this one is about to
            load_all(spark, folder, *make(spark, [building("2", "First"), building("3")], [energy("2"), energy("3", 2023)]))
        return publish(log, snapshot)

    monkeypatch.setattr(Log, "publish", late)
    b, e = load_all(spark, folder, *make(spark, [building("2", "Second"), building("3", "Second"), building("4")], [energy("2", eui=9.0), energy("4"), energy("3")]))
    assert calls == [2, 2, 3]
    want = [("1", "Ottawa"), ("2", "First"), ("3", "Ottawa"), ("4", "Ottawa")], [(1, "1", 2024), (2, "2", 2024), (3, "3", 2023), (4, "3", 2024), (5, "4", 2024)]
    assert state(spark, folder) == want == (pairs(b.select(S.KEY, "city")), pairs(e.select("performance_id", S.KEY, S.YEAR)))
    log = Log(spark, folder)
    assert log.unlisted(load.BUILDINGS) == log.unlisted(load.MEASURES) == []
    assert len(state(spark, folder, 2)[0]) == 3 and len(state(spark, folder, 1)[1]) == 1


def test_a_number_is_taken_once(spark):
    log = Log(spark, fresh_path(spark, "test-log"))
    assert log.last() == Snapshot()
    assert log.publish(Snapshot(1, {"t": ["t/batch=x"]}, 7))
    assert not log.publish(Snapshot(1, {"t": ["t/batch=y"]}, 8))
    assert log.last() == Snapshot(1, {"t": ["t/batch=x"]}, 7)
    assert [n for n in log._children(f"{log.folder}/_log") if not n.endswith(".crc")] == ["000000000001.json"]


def test_nothing_new_publishes_nothing(spark):
    folder = fresh_path(spark, "test-log")
    for _ in range(2):
        b, e = load_all(spark, folder, *make(spark, [building("1")], [energy("1")]))
    assert Log(spark, folder).last().number == 1 and (b.count(), e.count()) == (1, 1)
    empty = fresh_path(spark, "test-log")
    b, e = load_all(spark, empty, *make(spark, [], []))
    assert (b.count(), e.count()) == (0, 0) and Log(spark, empty).last().number == 0
    assert state(spark, empty) == ([], [])
    with pytest.raises(AnalysisException, match="no state 4"):
        load.read_loaded(spark, folder, 4)


def test_measures_without_a_year_or_buildings_only(spark):
    folder = fresh_path(spark, "test-log")
    load_all(spark, folder, *make(spark, [building("1")], []))
    for _ in range(2):
        load_all(spark, folder, *make(spark, [], [energy("1", None)]))
    assert state(spark, folder)[1] == [(1, "1", None), (2, "1", None)]


def test_tables_written_without_a_log_are_taken_over(spark):
    folder = fresh_path(spark, "test-log")
    b, e = make(spark, [building("1", "Old")], [energy("1", 2020), energy("1", 2021)])
    files.write_table(b, f"{folder}/buildings")
    numbered = load.with_dense_id(e, "performance_id", [S.KEY, S.YEAR], 5).select(*S.ENERGY_WITH_ID.names)
    files.write_table(numbered, f"{folder}/energy_performance", partition_by=S.YEAR)
    load_all(spark, folder, *make(spark, [building("1"), building("2")], [energy("1", 2021), energy("2", 2021)]))
    assert state(spark, folder) == ([("1", "Old"), ("2", "Ottawa")], [(5, "1", 2020), (6, "1", 2021), (7, "2", 2021)])
