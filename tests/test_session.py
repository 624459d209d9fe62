from types import SimpleNamespace

import pytest

from lumbung.session import fresh_folder, shared_folder


def session(master, folder):
    conf = SimpleNamespace(get=lambda key, default: folder)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_cluster_names_the_shared_folder():
    assert shared_folder(session("yarn", "hdfs://shared/")) == "hdfs://shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None))


def test_a_local_session_gets_one_temporary_folder():
    local = session("local[8]", None)
    assert shared_folder(local) == shared_folder(local)


def test_no_two_intermediate_tables_share_a_path(spark):
    assert fresh_folder(spark, "t") != fresh_folder(spark, "t")


def test_semantics_are_pinned(spark):
    assert (spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.ansi.enabled")) == ("UTC", "true")
