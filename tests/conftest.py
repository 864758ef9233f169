import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from issuelens.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def write_issues(tmp_path):
    def write(*documents, folder="raw"):
        target = tmp_path / folder
        target.mkdir(exist_ok=True)
        for doc in documents:
            (target / f"week_{doc['number']:03d}.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2), "utf-8")
        return str(target)

    return write
