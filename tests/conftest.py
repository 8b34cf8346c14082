import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# The workers find the same modules.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from rosterlake.session import build_session

    s = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="6g", spark__default__parallelism="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """The rows as sorted tuples of text."""
    return sorted((tuple(None if v is None else str(v) for v in r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
