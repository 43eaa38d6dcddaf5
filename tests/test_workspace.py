from types import SimpleNamespace

import pytest

from tablemove.sources import workspace
from tablemove.sources.estate import drop_schemas
from tablemove.plans import migrate
from tablemove.sources.inventory import inventory


def session(master, setting=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: setting),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_session_names_the_shared_folder(spark):
    assert workspace.shared_root(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    setting = spark.conf.get(workspace.CHECKPOINT_SETTING, None)
    assert workspace.new_area(spark, "x").startswith(setting or workspace.shared_root(spark))


def test_a_cluster_without_it_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_root(session("yarn"))


def test_a_local_session_gets_its_own_folder():
    assert workspace.shared_root(session("local[1]")) == workspace.shared_root(session("local[1]"))
    assert workspace.shared_root(session("local[1]")) != workspace.shared_root(session("local[2]"))


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_given_tables_survive_every_format(spark, pair, testdata, fmt):
    """Every table in every format; the copies check themselves by content."""
    from registry import TABLES
    from tablemove.operators.external import register

    for table in TABLES:
        register(spark, pair.src(table), "parquet", f"{testdata}/{table}.parquet")
    outcomes = migrate.copy_schema(spark, "src", pair.schema, "dst", fmt=fmt, on_error="continue")
    failed = {o.source_full_name.rsplit(".", 1)[1] for o in outcomes if o.failed}
    assert failed == ({"embeddings"} if fmt == "csv" else set())
    made = inventory(spark, "dst", pair.schema)
    assert made.filter(f"provider = '{fmt}'").count() == len(TABLES) - len(failed)
    drop_schemas(spark, "dst", [pair.schema])
