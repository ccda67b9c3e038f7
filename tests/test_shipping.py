"""Task functions run where the package cannot be imported."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from bibspark.session import local_session
from bibspark.operators import vectors as V
spark = local_session(2, shuffle=2, memory="1g")
df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], "id int, v array<double>")
print(V.knn(df, "id", "v", [1.0, 1.0], 3, None).count())
"""


def test_from_another_folder(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.split() == ["3"]
