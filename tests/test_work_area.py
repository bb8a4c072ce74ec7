"""Intermediates live in the application's own folder and go away with it."""

import os

from trailmark import config


def test_a_run_leaves_no_folder_behind(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(config, "work_dir", lambda _: str(tmp_path))
    assert config.work_table(spark.range(10), "numbers").count() == 10
    assert os.listdir(config.run_dir(spark)) and os.listdir(tmp_path) == [os.path.basename(config.run_dir(spark))]
    assert config.clean_work(spark)
    assert not os.listdir(tmp_path)
    assert not config.clean_work(spark)
