"""Materialisation helpers and the member reader's Parquet branch."""

from __future__ import annotations

import os

import pytest

from retentio.session import MATERIALIZE_CONF, default_materialize, ensure_checkpoint_dir, materialize


def test_tables_can_be_removed(spark):
    import subprocess
    import sys
    code = ("from retentio.session import *; s = local_session(1); t = written_table(s.range(3)); n = t.count();"
            "remove_written_tables(s); f = t.inputFiles()[0].split(':', 1)[-1]; print(n, os.path.exists(f))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.stdout.split()[-2:] == ["3", "False"], out.stderr[-500:]


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace as N
    unset = N(isDefined=lambda: False)
    sc = N(_jsc=N(sc=lambda: N(getCheckpointDir=lambda: unset)), master="yarn", getConf=lambda: N(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(N(sparkContext=sc))


def test_tables_live_under_the_checkpoint_folder(spark):
    out = materialize(spark.range(10), "table")
    files = out.inputFiles()
    base = ensure_checkpoint_dir(spark)
    assert files and all(f.startswith(base.rstrip("/")) or base.split(":", 1)[-1] in f for f in files)
    assert all("retentio-tables" in f for f in files)


def test_session_default_mode(spark):
    assert default_materialize(spark) == spark.conf.get(MATERIALIZE_CONF, "table")
    spark.conf.set(MATERIALIZE_CONF, "checkpoint")
    try:
        assert default_materialize(spark) == "checkpoint"
        assert materialize(spark.range(5)).count() == 5
    finally:
        spark.conf.unset(MATERIALIZE_CONF)


def test_member_reader_parquet_branch(spark, members_small, scratch):
    from retentio.sources.members import read_member_csv
    path = os.path.join(scratch, "members_parquet")
    members_small.write.parquet(path)
    back = read_member_csv(spark, path, fmt="parquet")
    assert back.count() == members_small.count()
    assert "member_key" in back.columns
