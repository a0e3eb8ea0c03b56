import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aloft.session import build_session, ensure_checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="aloft-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


def write_text(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)
