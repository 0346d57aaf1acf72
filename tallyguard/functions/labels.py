"""The fraud label rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.functions.text import fold, strip

FRAUD = "Fraud"
# The two labels that survive cleaning, folded.
KNOWN_LABELS = ("fraud", "normal")


def _fraud_condition(label: Column, mode: str) -> Column:
    if mode == "exact":
        return label == FRAUD
    if mode == "strip":
        return strip(label) == FRAUD
    if mode == "fold":
        return fold(label) == FRAUD.lower()
    raise ValueError(f"unknown label mode {mode!r}")


def fraud_flag(label: Column, mode: str = "exact") -> Column:
    """BIGINT 1 for a fraud label, else 0; a missing label counts as 0.

    ``mode`` is ``exact``, ``strip`` (white space ignored) or ``fold`` (case ignored as well).
    """
    return F.when(_fraud_condition(label, mode), 1).otherwise(0).cast("bigint")


def known_label(label: Column) -> Column:
    """True where the label is fraud or normal, white space and case ignored."""
    return fold(label).isin(*KNOWN_LABELS)
