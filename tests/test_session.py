from __future__ import annotations

import pytest

from tablekit.session import BASE_CONF, checkpoint_root, scratch_path


def test_checkpoint_root_is_the_session_folder(spark):
    root = checkpoint_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:  # taken from the session, not replaced
        assert configured.rstrip("/").split(":")[-1] in root


def test_a_cluster_must_name_its_checkpoint_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:1"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    for master in ("spark://host:1", "yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(ValueError, match="checkpoint"):
            checkpoint_root(Session())


def test_scratch_paths_are_fresh(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark))


def test_base_settings_applied(spark):
    for k in ["spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.session.timeZone"]:
        assert spark.conf.get(k) == BASE_CONF[k]
    assert spark.conf.get("spark.ui.enabled") == "false"


def test_cut_lineage_reads_back_the_same_rows(spark):
    from tablekit.sinks import cut_lineage
    df = spark.range(100).selectExpr("id", "id * 2 AS v")
    cut = cut_lineage(df)
    assert sorted(cut.collect()) == sorted(df.collect())
    from tablekit.plans.explain import plan_text
    plan = plan_text(cut)
    assert "Range" not in plan and "ExistingRDD" in plan  # reads the written copy
