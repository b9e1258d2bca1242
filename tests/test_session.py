import os
from types import SimpleNamespace

import pytest

from fieldbook.session import NoSharedFolder, intermediates, stored, work_folder


def session(master, folder=None):
    conf = {"spark.checkpoint.dir": folder}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, default=None: conf.get(k) or default, set=conf.__setitem__),
        sparkContext=SimpleNamespace(master=master),
    )


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(NoSharedFolder):
        work_folder(session(master), "x")
    assert work_folder(session(master, "hdfs://shared/dir/"), "x").startswith("hdfs://shared/dir/x-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_may_do_without(master):
    assert os.path.isdir(os.path.dirname(work_folder(session(master), "x")))


def test_intermediates_go_and_others_stay(spark):
    kept = stored(spark.range(3), "kept").inputFiles()
    with intermediates(spark):
        gone = stored(spark.range(3), "gone").inputFiles()
    assert all(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in kept)
    assert not any(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in gone)
