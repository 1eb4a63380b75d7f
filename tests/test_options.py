import pytest

from appendlog.sources.options import INT_MAX, ReadConfig, resolve
from appendlog.sources.pathspec import AppendLogError, parse_path


def test_conf_wins_over_option(spark):
    spark.conf.set("spark.appendlog.bytes.max", "77")
    try:
        opts = resolve(spark, **{"bytes.max": "5", "path": "/logs/service\\.log\\..*"})
    finally:
        spark.conf.unset("spark.appendlog.bytes.max")
    c = ReadConfig.from_options(opts)
    assert dict(c.as_rows()) == {
        "path": "/logs/service\\.log\\..*",
        "starting.offsets": "earliest",
        "bytes.max": "77",
        "md5.check.enabled": "true",
        "md5.sample.length": "1024",
        "offset.backup.provider": "table",
    }


def test_defaults():
    c = ReadConfig.from_options({"path": "/a/b.*"})
    assert c.max_bytes == INT_MAX and c.md5_sample == 1024 and c.md5_check
    assert c.spec.directory == "/a" and c.spec.pattern == "b.*"


@pytest.mark.parametrize("opts, msg", [
    ({}, "option path not set"),
    ({"path": ""}, "option path not set"),
    ({"path": "/a/b", "starting.offsets": "middle"}, "earliest or latest"),
    ({"path": "/a/b", "bytes.max": "0"}, "at least 1"),
    ({"path": "/a/b", "md5.check.enabled": "yes"}, "true or false"),
])
def test_rejects(opts, msg):
    with pytest.raises(AppendLogError, match=msg):
        ReadConfig.from_options(opts)


def test_node_segment():
    s = parse_path("/logs/{node}/app/svc\\.log")
    assert s.has_node and s.prefix == "/logs" and s.suffix == "/app"
    assert s.node_dir("h1") == "/logs/h1/app" and s.glob == "/logs/*/app"
    assert parse_path("/l[1]/{node}/x").glob == "/l\\[1\\]/*"
    assert s.node_depth == -3
    assert s.matches("svc.log") and not s.matches("svc.log.1") and not s.matches("xsvc.log")
    with pytest.raises(AppendLogError):
        parse_path("/logs/a{node}/x")
