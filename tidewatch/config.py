"""Rule parameters, scale limits and paths.

Everything a caller may tune lives in the three frozen dataclasses below; the
plan-building functions take them as arguments and hold no other state.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# ---------------------------------------------------------------------------
# They have to be these for results to be right.
# ---------------------------------------------------------------------------
RULE_POINTS = MappingProxyType(
    {
        "flag_structuring": 30,
        "flag_high_velocity": 25,
        "flag_high_risk_country": 20,
        "flag_amount_spike": 15,
        "flag_rapid_succession": 10,
    }
)
HIGH_RISK_COUNTRIES = ("CY", "MT", "PAN", "BVI", "SCH")
TIERS = ("HIGH", "MEDIUM", "LOW", "NONE")
CRITICAL_COLUMNS = ("transaction_id", "customer_id", "amount", "currency", "timestamp")
ALERT_COLUMNS = (
    "transaction_id",
    "customer_id",
    "timestamp",
    "amount",
    "currency",
    "channel",
    "originator_country",
    "beneficiary_country",
    "risk_score",
    "risk_tier",
    "flag_count",
    "rolling_7d_amount",
    "rolling_7d_count",
)
MODEL_FEATURES = (
    "rolling_7d_amount",
    "rolling_7d_count",
    "rolling_7d_avg",
    "amount_vs_7d_avg_ratio",
    "seconds_since_last_txn",
    "is_weekend",
    "is_offhours",
    "involves_high_risk_country",
    "cumulative_amount",
    "cumulative_count",
)
FLAG_TITLES = MappingProxyType(
    {
        "flag_structuring": "Structuring",
        "flag_high_velocity": "High Velocity",
        "flag_high_risk_country": "High-Risk Country",
        "flag_amount_spike": "Amount Spike",
        "flag_rapid_succession": "Rapid Succession",
    }
)
# Interface names: the environment variables that users set, with their defaults, and the topic.
PATH_VARIABLES = MappingProxyType(
    {
        "raw": ("AML_RAW_PATH", "data/raw/transactions"),
        "scored": ("AML_SCORED_PATH", "data/processed/txn_scored"),
        "customer_risk": ("AML_CUST_RISK_PATH", "data/processed/customer_risk"),
        "alerts_out": ("AML_ALERT_OUT_PATH", "output/alert_queue"),
        "customer_risk_out": ("AML_CUST_RISK_OUT_PATH", "output/customer_risk_profiles"),
        "output_dir": ("AML_OUTPUT_DIR", "output"),
        "run_log": ("AML_RUN_LOG_PATH", "output/run_log"),
        "reference_set": ("AML_REFERENCE_SET_PATH", "data/reference/high_risk_countries"),
    }
)
STREAM_VARIABLES = MappingProxyType(
    {
        "bootstrap_servers": ("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092"),
        "output": ("STREAMING_ALERT_OUTPUT", "output/streaming_alerts"),
        "checkpoint": ("STREAMING_CHECKPOINT", "output/streaming_checkpoints"),
        "trigger_interval": ("TRIGGER_INTERVAL", "10 seconds"),
        "producer_interval": ("PRODUCER_INTERVAL", "0.5"),
    }
)
THRESHOLD_VARIABLE = ("AML_ALERT_THRESHOLD", "25")
TOPIC = "aml_transactions"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rules:
    """Thresholds of the five typologies, of the score and of its tiers."""

    points: MappingProxyType = RULE_POINTS
    high_risk_countries: tuple[str, ...] = HIGH_RISK_COUNTRIES
    lookback_seconds: int = 7 * 86_400
    structuring_low: float = 9_000.0
    structuring_high: float = 9_999.99
    structuring_count: int = 3
    velocity_count: int = 5
    velocity_amount: float = 20_000.0
    spike_ratio: float = 3.0
    rapid_seconds: int = 300
    # Hours of the day outside [day_starts, day_ends) are off hours.
    day_starts: int = 6
    day_ends: int = 22
    high_score: int = 50
    medium_score: int = 25
    alert_threshold: int = 25
    # False keeps SQL's three-valued membership test: an unknown country makes
    # the flag, and with it the score, null.
    null_safe_countries: bool = True


@dataclass(frozen=True)
class Scale:
    """Limits that decide how per-customer history is computed.

    An input whose size estimate is at most ``small_input_bytes`` (about one
    scan split) cannot hold a customer too big for one task, so it skips the
    search for busy customers. Above that, a customer with more than
    ``busy_rows`` rows is split over many tasks. ``max_busy_customers`` bounds
    the broadcast list of such customers: the cut-off rises with the total row
    count, so at most that many can pass it.
    """

    small_input_bytes: int = 128 << 20
    busy_rows: int = 1_000_000
    max_busy_customers: int = 100_000
    # A shuffle task should handle about this much input, a scan task the other.
    shuffle_task_bytes: int = 192 << 20
    scan_task_bytes: int = 128 << 20
    max_shuffle_tasks: int = 200_000
    max_scan_tasks: int = 200_000


def _setting(variables: Mapping[str, tuple[str, str]], name: str, kind: type = str):
    """A field that takes its value from the environment when an object is made."""
    return field(default_factory=lambda: kind(os.environ.get(*variables[name])))


@dataclass(frozen=True)
class Paths:
    """Where the batch jobs read and write; each falls back to a default."""

    raw: str = _setting(PATH_VARIABLES, "raw")
    scored: str = _setting(PATH_VARIABLES, "scored")
    customer_risk: str = _setting(PATH_VARIABLES, "customer_risk")
    alerts_out: str = _setting(PATH_VARIABLES, "alerts_out")
    customer_risk_out: str = _setting(PATH_VARIABLES, "customer_risk_out")
    output_dir: str = _setting(PATH_VARIABLES, "output_dir")
    run_log: str = _setting(PATH_VARIABLES, "run_log")
    reference_set: str = _setting(PATH_VARIABLES, "reference_set")


@dataclass(frozen=True)
class StreamSettings:
    """Stream consumer and producer settings."""

    topic: str = TOPIC
    bootstrap_servers: str = _setting(STREAM_VARIABLES, "bootstrap_servers")
    output: str = _setting(STREAM_VARIABLES, "output")
    checkpoint: str = _setting(STREAM_VARIABLES, "checkpoint")
    trigger_interval: str = _setting(STREAM_VARIABLES, "trigger_interval")
    producer_interval: float = _setting(STREAM_VARIABLES, "producer_interval", float)


def rules_from_env() -> Rules:
    """Default rules with the alert threshold taken from the environment."""
    return Rules(alert_threshold=int(os.environ.get(*THRESHOLD_VARIABLE)))
