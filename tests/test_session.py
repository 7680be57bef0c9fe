from types import SimpleNamespace

import pytest

from tickmart.session import shared_dir


def with_setting(value):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: value if key == "spark.checkpoint.dir" else default))


def test_shared_folder_setting_wins():
    assert shared_dir(with_setting("s3a://b/ck/"), "x", fallback="/tmp/f") == "s3a://b/ck/x"
    assert shared_dir(with_setting(None), "x", fallback="/tmp/f/") == "/tmp/f/x"
    with pytest.raises(ValueError):
        shared_dir(with_setting(None), "x")
