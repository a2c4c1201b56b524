from collections import Counter

import pytest
from pyspark.sql import functions as F

from paylake.operators import uniqueness
from paylake.operators.quality import QualityError
from paylake.plans import job
from paylake.plans.bindings import raw_payments, write_csv
from paylake.plans.stages import JobConfig, run_stages

SF_DIR = "/root/testdata/sf0.001"


def keyed(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "Record_ID string, n int")


def found(df):
    return {r.Record_ID: r.row_count for r in uniqueness.duplicate_keys(df).collect()}


KEYS = ["a", "b", "a", None, None, "", "", "c", " c", "A", "long key" * 50, *["hot"] * 40]


def expected(keys):
    return {k: n for k, n in Counter(k for k in keys if k is not None).items() if n > 1}


def test_duplicate_keys(spark):
    assert found(keyed(spark, KEYS)) == expected(KEYS) == {"a": 2, "": 2, "hot": 40}
    assert found(keyed(spark, ["a", None, "b", None])) == {}
    assert found(keyed(spark, KEYS).limit(0)) == {}


@pytest.mark.parametrize("mark", [F.length, lambda key: F.lit(7)])
def test_keys_that_share_a_fingerprint_stay_apart(spark, monkeypatch, mark):
    monkeypatch.setattr(uniqueness, "fingerprint", mark)
    assert found(keyed(spark, KEYS)) == expected(KEYS)


def test_one_row_says_how_unique(spark):
    said = uniqueness.key_uniqueness(keyed(spark, KEYS)).collect()
    assert [tuple(r) for r in said] == [(3, 1 + 1 + 39, 40)]
    assert tuple(uniqueness.key_uniqueness(keyed(spark, ["x"])).first()) == (0, 0, 0)


def test_other_key_names(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "`a.b` long, row_count long")
    assert uniqueness.duplicate_keys(df, "a.b").collect() == [(1, 2)]
    with_marks = spark.createDataFrame([("k", 1), ("k", 2)], "_key string, _mark int")
    assert uniqueness.duplicate_keys(with_marks, "_key").collect() == [("k", 2)]


def test_only_fingerprints_are_shuffled_to_find_suspects(spark):
    plan = uniqueness.duplicate_keys(keyed(spark, KEYS))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    first = [line for line in physical.splitlines() if "Exchange hashpartitioning(_mark" in line]
    assert first and physical.count("partial_count") == 2


def test_a_run_is_stopped_before_gold_is_replaced(spark, tmp_path):
    rows = raw_payments(spark, SF_DIR).filter("Date_of_Payment LIKE '01/1%/1996'")
    once = write_csv(rows, str(tmp_path / "once"))
    one = rows.filter("Record_ID IS NOT NULL").orderBy("Record_ID").limit(1)
    twice = write_csv(rows.unionByName(one), str(tmp_path / "twice"))

    def config(source):
        return JobConfig(
            input_path=source,
            silver_path=str(tmp_path / "silver"),
            staging_table="unique_staging",
            gold_table="unique_gold",
            gold_path=str(tmp_path / "gold"),
            unique_key=True,
        )

    counts = run_stages(spark, config(once))
    with pytest.raises(QualityError, match=rf"{one.first().Record_ID} \(2 rows\)"):
        run_stages(spark, config(twice))
    assert spark.table("unique_gold").count() == counts.gold > 0


def test_command_line(capsys):
    paths = ["--input_path=a", "--output_path=b", "--unique_key"]
    with pytest.raises(SystemExit):
        job.parse_args(paths)
    assert "unique_key" in capsys.readouterr().err
    job.parse_args([*paths, "--gold_table=g"])
