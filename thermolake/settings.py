"""Fixed values shared by the operators. Every one is also a function argument."""

from __future__ import annotations

# The machines a reading may come from.
MACHINES = ("CNC_MILL_01", "ROBOTIC_ARM_02", "ASSEMBLY_LINE_03")

# Plausible sensor range (inclusive) and the anomaly threshold (exclusive).
TEMPERATURE_MIN_C = -50.0
TEMPERATURE_MAX_C = 200.0
ANOMALY_THRESHOLD_C = 85.0

# Fixed value: highest anomaly rate the quality gate lets through.
MAX_ANOMALY_RATE = 0.60

# Retrieval depth, fusion constant, answer length, chunk size.
TOP_K_RETRIEVE = 8
TOP_K_FINAL = 4
RRF_K = 60
MAX_SENTENCES = 3
SENTENCES_PER_CHUNK = 2

# Okapi BM25 constants.
BM25_K1 = 1.5
BM25_B = 0.75
BM25_EPSILON = 0.25

# Upper bound in bytes for data an operator collects and broadcasts. Larger inputs take
# another (exact) route, see operators/block_topk.py.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
