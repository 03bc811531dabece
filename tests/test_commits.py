"""Outputs that become visible together."""

from __future__ import annotations

import os

import pytest

from conftest import COOKIE_LABELS, VISIT_LOG, write_lines
from weft.plans import visits
from weft.sinks.commits import Commits, Conflict


def test_a_commit_shows_all_outputs_and_a_second_writer_fails(spark, tmp_path):
    base = str(tmp_path / "out")
    commits = Commits(spark, base)
    assert commits.latest() is None
    with pytest.raises(FileNotFoundError):
        commits.read("a")
    one, other = commits.begin(), commits.begin()
    for run, n in ((one, 3), (other, 5)):
        spark.range(n).write.parquet(run.path("a"))
        spark.range(2 * n).write.parquet(run.path("b"))
    assert commits.latest() is None
    assert one.commit(said="x").number == 1
    with pytest.raises(Conflict):
        other.commit()
    assert (commits.read("a").count(), commits.read("b").count(), commits.latest().notes) == (3, 6, {"said": "x"})
    assert not [f for f in os.listdir(tmp_path / "out" / "_committed") if f.startswith("_draft")]
    third = commits.begin()
    spark.range(7).write.parquet(third.path("a"))
    old = commits.latest()
    third.commit()
    assert commits.read("a").count() == 7 and spark.read.parquet(old.path("a")).count() == 3
    assert commits.numbers() == [1, 2]
    assert commits.expire(keep=1) == [other.folder] or len(commits.numbers()) == 1
    assert sorted(os.listdir(tmp_path / "out")) == sorted(["_committed", os.path.basename(third.folder)])
    assert commits.read("a").count() == 7 and commits.begin().number == 3


def test_a_job_killed_between_sinks_leaves_the_old_outputs(spark, tmp_path, monkeypatch):
    log, lab, out = write_lines(tmp_path / "log.txt", VISIT_LOG), write_lines(tmp_path / "lab.txt", COOKIE_LABELS), str(tmp_path / "out")
    first = visits.run_visit_job(spark, log, lab, out, sink="parquet", together=True)
    assert first["generation"] == 1 and first["session_count"] == 3

    def seen():
        commits = Commits(spark, out)
        return {name: sorted(map(str, commits.read(name).collect())) for name in ("trackerLog", "trackerSession", "rejects")}

    before = seen()
    more = write_lines(tmp_path / "log2.txt", VISIT_LOG[:5] + ["pageview|short"])
    real, calls = visits.select_sink, []

    def dying(name):
        write = real(name)

        def once(df, path):
            calls.append(path)
            if len(calls) == 2:
                raise RuntimeError("killed")
            write(df, path)
        return once

    monkeypatch.setattr(visits, "select_sink", dying)
    with pytest.raises(RuntimeError):
        visits.run_visit_job(spark, more, lab, out, sink="parquet", together=True)
    assert len(calls) == 2 and seen() == before
    monkeypatch.setattr(visits, "select_sink", real)
    assert visits.run_visit_job(spark, more, lab, out, sink="parquet", together=True)["generation"] == 2
    after = seen()
    assert all(after[name] != before[name] for name in before)
