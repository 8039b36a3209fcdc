"""Session defaults and the shared checkpoint folder."""

from snapflow.session import SESSION_DEFAULTS, apply_defaults, checkpoint_dir, scratch_path


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = checkpoint_dir(spark)
    # Spark nests a per-application folder under the configured one
    assert configured and got.replace("file:", "").startswith(configured.replace("file:", ""))


def test_scratch_paths_are_fresh_and_under_the_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_dir(spark))


def test_defaults_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_defaults(spark)
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.mapKeyDedupPolicy"):
        assert spark.conf.get(key) == SESSION_DEFAULTS[key]


def test_object_store_settings_reach_the_session():
    from snapflow.__main__ import _parser, store_settings

    args = _parser().parse_args(["status", "--root", "s3a://b/x", "--store-endpoint", "objects.local:9000", "--store-ssl"])
    conf = store_settings(args)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "objects.local:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert store_settings(_parser().parse_args(["status", "--root", "x"])) == {}


def test_unknown_defaults_are_not_swallowed(spark, monkeypatch):
    import pytest

    from snapflow import session

    monkeypatch.setitem(session.SESSION_DEFAULTS, "spark.sql.warehouse.dir", "elsewhere")
    with pytest.raises(Exception):
        apply_defaults(spark)
