"""Settings of the jobs, from the environment."""

from __future__ import annotations

import os

# Variable names and defaults that the jobs accept.
SERVERS = os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
TOPIC = os.environ.get("KAFKA_TOPIC") or os.environ.get("KAFKA_TOPIC_RAW", "bank.transactions.raw")
BRONZE = os.environ.get("SPARK_BRONZE_PATH", "/data/lake/bronze/transactions")
GOLD = os.environ.get("SPARK_GOLD_PATH", "/data/lake/gold/batch_summary")
CHECKPOINT = os.environ.get("SPARK_CHECKPOINT_SPEED", "/checkpoint/speed-layer")
