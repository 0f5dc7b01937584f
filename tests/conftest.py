import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
# Python workers import the package from here.
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import local_session, ship_package

    session = local_session(cores=4, **{"spark__sql__shuffle__partitions": "4", "spark__driver__memory": "4g"})
    ship_package(session)
    return session
