"""The shared checkpoint folder comes from the session; a scratch folder is made
only when the session names none."""

from pitchlake.session import checkpoint_dir, ensure_defaults, scratch_path


def test_checkpoint_dir_from_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert configured
    d = checkpoint_dir(spark)
    assert d == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(d.rstrip("/") + "/x-") and a != b


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):  # noqa: N802 (Spark's name)
        return self.dir

    def setCheckpointDir(self, d):  # noqa: N802
        self.dir = d


class _Session:
    conf = _Conf()

    def __init__(self):
        self.sparkContext = _Context()


def test_scratch_folder_only_when_unset():
    s = _Session()
    d = checkpoint_dir(s)
    assert d and s.sparkContext.dir == d  # registered on the context, conf untouched
    assert checkpoint_dir(s) == d


def test_defaults_do_not_override(spark):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        ensure_defaults(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
