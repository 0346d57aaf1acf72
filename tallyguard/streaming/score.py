"""Scoring on the stream and alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.operators.behaviour import HistoryColumns
from tallyguard.operators.features import FeatureColumns, feature_table
from tallyguard.operators.models import FraudModel, score_batch
from tallyguard.sources.topic import to_messages
from tallyguard.streaming.history import MessageColumns, enrich_into
from tallyguard.streaming.ingest import TRIGGER_SECONDS, triggered

THRESHOLD = 0.5


def stream_score(model: FraudModel, transactions: DataFrame, names: FeatureColumns = FeatureColumns()) -> DataFrame:
    """Features with the fill values kept from training, then the fitted model; batch or stream."""
    features = feature_table(transactions, names, hour_fill=model.hour_fill)
    return score_batch(model, features)


def score_into(
    model: FraudModel,
    transactions: DataFrame,
    path: str,
    state: str,
    checkpoint: str,
    names: HistoryColumns,
    out: MessageColumns = MessageColumns(),
    columns: FeatureColumns = FeatureColumns(),
    threshold: float | None = None,
    send: Callable[[DataFrame], None] | None = None,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Score messages with the history of their customers, which ``state`` keeps, into ``path``, a folder a batch.

    With a threshold only alerts are kept; ``send`` gets them as messages instead of a folder. A repeated batch
    replaces its folder, or sends its alerts again.
    """

    def use(batch: DataFrame, number: int) -> None:
        scored = stream_score(model, batch, columns)
        rows = scored if threshold is None else stream_alerts(scored, threshold)
        if send:
            send(to_messages(rows, "transaction_id"))
        else:
            rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return enrich_into(
        transactions, use, state, checkpoint, names, out, trigger_seconds=trigger_seconds, available_now=available_now
    )


def alerts_to_topic(
    alerts: DataFrame,
    send: Callable[[DataFrame], None],
    checkpoint: str,
    key: str = "transaction_id",
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Send every alert as a message, key and JSON of the row; a repeated batch sends its alerts again."""
    writer = alerts.writeStream.foreachBatch(lambda batch, _: send(to_messages(batch, key)))
    return triggered(writer.option("checkpointLocation", checkpoint), trigger_seconds, available_now).start()


def stream_alerts(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose fraud probability reaches the threshold."""
    return scored.where(F.col("fraud_probability") >= threshold)
