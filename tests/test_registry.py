"""Snapshots of small rows: conflicts, bounded files, several writers."""

from __future__ import annotations

import threading

import pytest

from spendcast import registry
from spendcast.functions.scoring import Polynomial
from spendcast.plans import training as tr
from spendcast.schemas import FEATURES
from spendcast.workspace import remove_folder

MODEL = Polynomial.plain(FEATURES, 1, [1.0, 2.0, 3.0, 4.0], 0.1)
REPORT = {"train_r2": 0.9, "train_threshold": 0.85, "test_r2": 0.9, "test_threshold": 0.85, "model_saved": True}


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_rows_before_and_after_commits(spark, tmp_path):
    log = registry.SnapshotLog(spark, str(tmp_path / "log"))
    assert log.rows() == []
    log.append({"n": 1, "t": "é"}, keep=3)
    log.commit(lambda rows: [*rows, {"n": 2, "t": None}])
    assert log.rows() == [{"n": 1, "t": "é"}, {"n": 2, "t": None}]
    for n in range(10):
        log.append({"n": n}, keep=3)
    assert [r["n"] for r in log.rows()] == [7, 8, 9]
    assert len(files(tmp_path / "log")) == 3
    before = files(tmp_path / "log")
    log.commit(lambda rows: rows)
    assert files(tmp_path / "log") == before


def test_a_conflict_starts_again_from_the_other_writers_rows(spark, tmp_path):
    log = registry.SnapshotLog(spark, str(tmp_path / "log"))
    seen = []

    def change(rows):
        seen.append(list(rows))
        if len(seen) == 1:  # another writer commits between the read and the rename
            log.append({"n": "other"}, keep=9)
        return [*rows, {"n": "mine"}]

    log.commit(change)
    assert seen == [[], [{"n": "other"}]]
    assert log.rows() == [{"n": "other"}, {"n": "mine"}]


def test_a_leftover_of_a_crash_is_no_snapshot(spark, tmp_path):
    log = registry.SnapshotLog(spark, str(tmp_path / "log"))
    log.append({"n": 1}, keep=3)
    registry.write_text(spark, str(tmp_path / "log" / ".new-x"), "half of it")
    assert log.rows() == [{"n": 1}]
    log.append({"n": 2}, keep=3)
    assert log.rows() == [{"n": 1}, {"n": 2}]


def test_two_writers_lose_no_run(spark, tmp_path):
    root = str(tmp_path)
    errors = []

    def write(name):
        try:
            for n in range(25):
                tr.save_model(spark, root, None, REPORT | {"model_saved": False}, version=1000 * name + n)
        except Exception as error:  # noqa: BLE001 - handed to the test
            errors.append(error)

    writers = [threading.Thread(target=write, args=(name,)) for name in (1, 2)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert errors == []
    assert sorted(r["version"] for r in tr.model_runs(spark, root).collect()) == [*range(1000, 1025), *range(2000, 2025)]


def test_many_runs_leave_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tr, "KEPT_RUNS", 20)
    root = str(tmp_path)
    first = tr.save_model(spark, root, MODEL, REPORT, version=0)
    assert tr.load_model(spark, first) == MODEL
    counts = set()
    for n in range(1, 120):
        tr.save_model(spark, root, MODEL if n < 90 else None, REPORT | {"model_saved": n < 90}, version=n)
        if n > 30:
            counts.add(len(files(tmp_path)))
    assert counts == {3 + tr.KEPT_MODELS}
    # The current model outlives the runs that failed after it.
    assert tr.current_run(spark, root)["version"] == 89
    assert tr.current_model(spark, root) == MODEL
    assert tr.model_runs(spark, root).count() == 21
    with pytest.raises(LookupError):
        tr.load_model(spark, first)


def test_a_version_trained_again_is_a_run_of_its_own(spark, tmp_path):
    root = str(tmp_path)
    paths = [tr.save_model(spark, root, MODEL, REPORT, version=1) for _ in range(2)]
    assert len(set(paths)) == 2 and all(p.endswith("version=1") for p in paths)
    assert tr.is_trained(spark, root, 1) and not tr.is_trained(spark, root, 2)
    remove_folder(spark, paths[1])
    with pytest.raises(LookupError, match="no model at"):
        tr.current_model(spark, root)
