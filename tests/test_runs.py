"""The run log, and runs that go on where the last one failed."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from paylake.operators.quality import QualityError
from paylake.plans import manifest, runlog, stages
from paylake.plans.bindings import raw_payments, write_csv
from paylake.plans.stages import JobConfig, run_stages
from paylake.schema import GOLD_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def csv_dir(spark, tmp_path):
    rows = raw_payments(spark, SF_DIR).filter("Date_of_Payment LIKE '0%/1%/1996' OR Record_ID IS NULL")
    return write_csv(rows.repartition(2), str(tmp_path / "raw"))


def config(csv_dir, tmp_path, **more):
    return JobConfig(
        input_path=csv_dir,
        silver_path=str(tmp_path / "silver"),
        staging_table="runs_staging",
        gold_table=f"runs_gold_{tmp_path.name}",
        gold_path=str(tmp_path / "gold"),
        **more,
    )


def test_two_good_runs_and_a_failed_one_are_three_rows(spark, csv_dir, tmp_path):
    path = str(tmp_path / "log")
    good = config(csv_dir, tmp_path, run_log=path)
    counts = [run_stages(spark, good) for _ in range(2)]
    before = dt.datetime.now()
    with pytest.raises(QualityError):
        run_stages(spark, dataclasses.replace(good, max_bad_share=0.001))
    rows = runlog.read_runs(spark, path).orderBy("started_at").collect()
    assert [r.status for r in rows] == ["done", "done", "failed"]
    assert [[s.stage for s in r.stages] for r in rows] == [["silver", "quality", "staging", "gold"]] * 2 + [
        ["silver", "quality"]
    ]
    assert (rows[2].failed_stage, rows[2].error[:13]) == ("quality", "QualityError:")
    assert rows[0].failed_stage is None and rows[0].error is None
    assert len({r.run_id for r in rows}) == 3 and rows[2].started_at >= rows[1].started_at
    for r, c in zip(rows, counts, strict=False):
        silver, gold = r.stages[0], r.stages[3]
        assert (silver.rows["raw"], silver.rows["silver"], gold.rows["gold"]) == (c.raw, c.silver, c.gold)
        assert 0 < silver.seconds <= r.seconds and r.started_at <= before
    measures = runlog.stage_rows(runlog.read_runs(spark, path)).collect()
    assert {m.measure for m in measures if m.stage == "silver"} >= {"raw", "silver", "rejected", "refused"}
    compared = runlog.changes(runlog.read_runs(spark, path)).orderBy("started_at").collect()
    assert [(c.gold, c.gold_change) for c in compared] == [(counts[0].gold, None), (counts[1].gold, 0)]


def test_an_error_of_the_log_does_not_hide_the_runs_own(spark, tmp_path):
    (tmp_path / "file").write_text("no folder")
    with pytest.raises(KeyError, match="own"), runlog.recorded(spark, str(tmp_path / "file" / "log"), "job"):
        raise KeyError("own")


def test_failure_in_gold_then_rerun_reads_no_csv(spark, csv_dir, tmp_path, monkeypatch):
    cfg = config(csv_dir, tmp_path, manifest=str(tmp_path / "done"), run_log=str(tmp_path / "log"))
    with monkeypatch.context() as m:
        m.setattr(stages, "to_gold", lambda df: df.withColumn("x", F.raise_error(F.lit("gold fails"))))
        with pytest.raises(Exception, match="gold fails|payment_date"):
            run_stages(spark, cfg)
    reads = []
    read = stages.read_records
    monkeypatch.setattr(stages, "read_records", lambda *a, **k: reads.append(a) or read(*a, **k))
    resumed = run_stages(spark, cfg)
    assert not reads and resumed.gold > 0
    third = run_stages(spark, cfg)
    assert third == resumed and not reads
    status = [
        {s.stage: s.status for s in r.stages}
        for r in runlog.read_runs(spark, cfg.run_log).orderBy("started_at").collect()
    ]
    assert status[0] == {"silver": "done", "quality": "done", "staging": "done", "gold": "failed"}
    assert (status[1]["silver"], status[1]["gold"]) == ("skipped", "done")
    assert (status[2]["silver"], status[2]["gold"]) == ("skipped", "skipped")
    # The same as a run that remembers nothing.
    plain = run_stages(spark, dataclasses.replace(cfg, manifest=None))
    assert plain == resumed and reads


def test_changed_inputs_settings_and_results_are_done_again(spark, csv_dir, tmp_path, monkeypatch):
    cfg = config(csv_dir, tmp_path, manifest=str(tmp_path / "done"))
    first = run_stages(spark, cfg)
    reads = []
    read = stages.read_records
    monkeypatch.setattr(stages, "read_records", lambda *a, **k: reads.append(a) or read(*a, **k))
    run_stages(spark, cfg)
    assert len(reads) == 0
    # Another setting, with another result.
    run_stages(spark, dataclasses.replace(cfg, quarantine_path=str(tmp_path / "q")))
    assert len(reads) == 1
    # Back again: the last event is of other inputs.
    run_stages(spark, cfg)
    assert len(reads) == 2
    # One more file.
    extra = raw_payments(spark, SF_DIR).filter("Date_of_Payment LIKE '0%/2%/1996'")
    extra.coalesce(1).write.mode("append").csv(csv_dir, header=True, escape='"', emptyValue="")
    more = run_stages(spark, cfg)
    assert len(reads) == 3 and more.gold > first.gold
    # Silver is not whole.
    (tmp_path / "silver" / "_SUCCESS").unlink()
    assert run_stages(spark, cfg) == more and len(reads) == 4
    # Gold was replaced by someone else.
    rows = sorted(map(repr, spark.table(cfg.gold_table).select(*GOLD_COLUMNS).collect()))
    stages.build_gold(spark.table(cfg.staging_table).limit(5), cfg.gold_table, cfg.gold_path)
    assert run_stages(spark, cfg) == more and len(reads) == 4
    assert sorted(map(repr, spark.table(cfg.gold_table).select(*GOLD_COLUMNS).collect())) == rows


def test_a_stage_that_started_later_is_not_finished(spark, tmp_path):
    done = manifest.Manifest(spark, str(tmp_path / "m"))
    assert done.finished("silver", "x") is None
    done.start("silver", "x")
    event = done.finish("silver", "x", "made", {"raw": 1})
    assert done.finished("silver", "x") == manifest.Done(event, "made", {"raw": 1})
    assert done.finished("silver", "y") is None and done.finished("gold", "x") is None
    done.start("silver", "y")
    assert done.finished("silver", "x") is None


def test_signature_is_of_names_sizes_and_times(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in "ab":
        (folder / f"{name}.csv").write_text("x")
    seen = [manifest.signature(spark, str(folder))]
    assert manifest.signature(spark, str(folder)) == seen[0]
    seen.append(manifest.signature(spark, str(folder), strict=True))
    (folder / "a.csv").write_text("xy")
    seen.append(manifest.signature(spark, str(folder)))
    (folder / "c.csv").write_text("x")
    seen.append(manifest.signature(spark, str(folder)))
    assert len(set(seen)) == 4
    plan = manifest.list_files(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
