"""The shared folder."""

from types import SimpleNamespace

import pytest

from shelfline import session


def fake(master):
    context = SimpleNamespace(getCheckpointDir=lambda: None, applicationId=f"app-{master}", master=master)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_a_local_session_gets_a_folder(master):
    assert session.shared_dir(fake(master), "a").endswith("/a")


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "yarn", "spark://host:7077"])
def test_executors_of_their_own_need_a_shared_folder(master):
    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(fake(master), "a")
