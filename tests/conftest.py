import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from intakeyard.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app="intakeyard-tests",
                      extra={"spark.sql.files.maxPartitionBytes": "4096",
                             "spark.sql.files.openCostInBytes": "1024"})
    yield s


@pytest.fixture
def lines_file(tmp_path):
    """Write text files (one per list) into a fresh folder; returns a writer."""
    counter = iter(range(10 ** 6))

    def write(*files_lines, name="in"):
        d = tmp_path / f"{name}-{next(counter)}"
        d.mkdir()
        for i, lines in enumerate(files_lines):
            (d / f"part-{i:05d}.txt").write_text("".join(line + "\n" for line in lines), encoding="utf-8")
        return str(d)
    return write
