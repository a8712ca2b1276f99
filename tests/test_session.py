"""Kept tables go when their application ends."""

import subprocess
import sys
from pathlib import Path

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from riskweave.session import local_session, materialise
spark = local_session(2, 2, "1g")
kept = materialise(spark.range(10))
assert kept.count() == 10
print("KEPT", kept.inputFiles()[0].removeprefix("file://"))
spark.stop()
"""


def test_kept_tables_are_removed_at_the_end():
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(root=root)], check=True, timeout=120, capture_output=True, text=True
    )
    kept = Path(done.stdout.partition("KEPT ")[2].split()[0])
    assert "riskweave-tables" in kept.parts and not kept.parent.parent.exists()
