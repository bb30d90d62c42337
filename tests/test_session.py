"""The shared folder and session defaults."""

from sluice.session import DEFAULT_CONF, shared_path, shared_root


def test_shared_path_under_checkpoint_dir(spark):
    root = shared_root(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    a, b = shared_path(spark, "x", "y"), shared_path(spark, "x", "y")
    assert a != b and a.startswith(root + "/sluice/x/y/")
    assert shared_path(spark, "tables", unique=False) == root + "/sluice/tables"


def test_checkpoint_is_reliable(spark):
    shared_root(spark)
    df = spark.range(10).checkpoint(eager=True)
    assert df.count() == 10


def test_defaults_turn_on_adaptive_execution():
    assert DEFAULT_CONF["spark.sql.adaptive.enabled"] == "true"
    assert DEFAULT_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert DEFAULT_CONF["spark.ui.enabled"] == "false"


def test_build_session_applies_defaults():
    import json
    import subprocess
    import sys
    from pathlib import Path

    repo = str(Path(__file__).resolve().parents[1])
    code = (
        f"import sys, json; sys.path.insert(0, {repo!r})\n"
        "from sluice import build_session\n"
        "s = build_session(master='local[2]', shuffle_partitions=4)\n"
        "keys = ['spark.sql.adaptive.forceOptimizeSkewedJoin', 'spark.sql.adaptive.autoBroadcastJoinThreshold',\n"
        "        'spark.sql.shuffle.partitions', 'spark.sql.session.timeZone']\n"
        "print('CONF ' + json.dumps({k: s.conf.get(k) for k in keys}))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
    conf = json.loads([ln for ln in out.splitlines() if ln.startswith("CONF ")][-1][5:])
    assert conf["spark.sql.adaptive.forceOptimizeSkewedJoin"] == "true"
    assert conf["spark.sql.shuffle.partitions"] == "4" and conf["spark.sql.session.timeZone"] == "UTC"
    assert conf["spark.sql.adaptive.autoBroadcastJoinThreshold"].lower() in ("32mb", "33554432", "33554432b")
