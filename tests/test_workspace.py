import pytest

from riskflow import workspace


def test_shared_root_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_root(spark) == root.rstrip("/")
    a, b = workspace.new_run(spark, "x"), workspace.new_run(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/runs/x-")


def test_an_unset_folder(spark, monkeypatch):
    monkeypatch.setattr(workspace, "CONF_KEY", "spark.riskflow.no.such.setting")
    monkeypatch.setattr(workspace, "master", lambda s: "spark://host:7077")
    monkeypatch.setattr(workspace, "_context_folder", lambda s: None)
    with pytest.raises(RuntimeError, match="no.such.setting"):
        workspace.shared_root(spark)
    found = []
    monkeypatch.setattr(workspace, "master", lambda s: "local[2]")
    monkeypatch.setattr(workspace, "_context_folder", lambda s: found[-1] if found else None)

    class Context:
        def setCheckpointDir(self, path):  # noqa: N802
            found.append(path)

    class Session:
        conf, sparkContext = spark.conf, Context()  # noqa: N815
    assert workspace.shared_root(Session()) == found[0]      # set on the context, no session setting is changed


def test_connector_probe(spark):
    from riskflow.operators.avro import spark_avro_available
    # the module does not ship with this PySpark; decoding falls back to array operations
    assert spark_avro_available(spark) is False
