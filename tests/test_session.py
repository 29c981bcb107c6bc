import pytest

from stockroute.session import ENGINE_CONF, scratch_path, scratch_root


def test_scratch_root_is_the_configured_checkpoint_folder(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured and configured.rstrip("/").endswith(root.split("/")[-1])


def test_scratch_paths_are_unique_and_below_the_root(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(scratch_root(spark)) and b.startswith(scratch_root(spark))


def test_engine_settings_applied(spark):
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.session.timeZone"):
        assert spark.conf.get(key) == ENGINE_CONF[key]


@pytest.mark.parametrize("master, allowed", [("local[4]", True), ("local", True), ("yarn", False),
                                             ("spark://h:7077", False), ("local-cluster[2,1,1024]", False)])
def test_unset_folder_is_an_error_on_a_cluster(monkeypatch, tmp_path, master, allowed):
    class Context:
        def __init__(self):
            self.master, self.made = master, None

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.made = path

    class Session:
        sparkContext, conf = Context(), type("Conf", (), {
            "get": lambda self, k, d=None: d, "set": lambda self, k, v: None})()

    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    if allowed:
        assert scratch_root(Session()) == Session.sparkContext.made
    else:
        with pytest.raises(ValueError, match="checkpoint.dir"):
            scratch_root(Session())
