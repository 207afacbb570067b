"""The work folder of a session without a shared one."""

from types import SimpleNamespace

import pytest

from parcelflow import session


def plain(master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_a_local_session_gets_one_folder_of_its_own():
    folder = session.shared_dir(plain("local[2]"))
    assert folder == session.shared_dir(plain("local[2]"))
    assert session.new_work_dir(plain("local[2]"), "x").startswith(f"{folder}/x-")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(plain("spark://host:7077"))


def test_many_folders_are_listed_by_a_few_tasks(spark):
    """One task a folder made every batch slower by the number of those before it."""
    listers = int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"))
    assert 0 < listers <= 4 * spark.sparkContext.defaultParallelism
