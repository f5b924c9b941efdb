"""Functions sent to Python workers need no copy of the package there."""

import os
import subprocess
import sys

from pyspark import cloudpickle

from thermolake.operators import bm25, block_topk

LOAD = """
import pickle, sys
import numpy as np
best, weights = pickle.loads(sys.stdin.buffer.read())
row, query, value = best(np.array([[1.0], [3.0]]), np.arange(2), np.full(1, -np.inf), 1)
assert row.tolist() == [1] and weights.__name__ == "_QueryWeights"
assert "thermolake" not in sys.modules
"""


def test_functions_carry_their_code(tmp_path):
    data = cloudpickle.dumps((block_topk.best_per_query, bm25._QueryWeights))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LOAD], input=data, cwd=tmp_path, env=env, capture_output=True)
    assert done.returncode == 0, done.stderr.decode()
