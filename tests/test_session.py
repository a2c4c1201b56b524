from types import SimpleNamespace

import pytest

from paylake import session


def fake(master, app="app-1", **conf):
    return SimpleNamespace(
        sparkContext=SimpleNamespace(applicationId=app, master=master),
        conf=SimpleNamespace(get=conf.get),
    )


def test_scratch_is_under_the_shared_folder():
    spark = fake("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.scratch_dir(spark) == "hdfs:///shared/paylake-app-1"


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("yarn"))


def test_local_mode_falls_back_to_one_local_folder(tmp_path, monkeypatch):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path / prefix))
    spark = fake("local[2]", app="app-2")
    assert session.scratch_dir(spark) == session.scratch_dir(spark) == str(tmp_path / "paylake-")
