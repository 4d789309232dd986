"""Table schemas and the parameters of a report run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

from tidemark import fixed_values as fv

PARAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField(
            "value",
            T.StructType(
                [
                    T.StructField("string_value", T.StringType()),
                    T.StructField("int_value", T.LongType()),
                ]
            ),
        ),
    ]
)

# Nested analytics export; event_date is YYYYMMDD text, event_timestamp is epoch microseconds.
RAW_EVENTS = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_params", T.ArrayType(PARAM)),
        T.StructField(
            "ecommerce",
            T.StructType(
                [
                    T.StructField("transaction_id", T.StringType()),
                    T.StructField("purchase_revenue", T.DoubleType()),
                ]
            ),
        ),
    ]
)

# The twelve columns of the daily table, in their published order.
DAILY = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("channel", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in fv.DAILY_COUNTS[:7]],
        T.StructField("revenue", T.DoubleType()),
        *[T.StructField(c, T.LongType()) for c in fv.DAILY_COUNTS[7:]],
    ]
)

SPEND = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("channel", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("is_simulated", T.BooleanType()),
    ]
)

NARRATIVE = T.StructType(
    [
        T.StructField("summary", T.StringType()),
        T.StructField("findings", T.ArrayType(T.StringType())),
        T.StructField("checks", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Settings:
    """Everything a run can be tuned with; the defaults are the published ones."""

    start_date: date = date(2020, 11, 1)
    end_date: date = date(2021, 1, 31)
    channels: tuple[str, ...] = fv.CHANNELS
    paid_channels: tuple[str, ...] = fv.PAID_CHANNELS
    currency: str = "USD"
    baseline_days: int = 28
    max_anomalies: int = 8
    top_movers: int = 3
    metrics: tuple[str, ...] = fv.DAILY_METRICS
    z_threshold: float = 3.5
    min_baseline_days: int = 14
    min_daily_volume: float = 5
    cost_wow_increase: float = 0.40
    conversion_rate_wow_drop: float = 0.30
    sessions_stable_max_change: float = 0.10
    revenue_share_change_pp: float = 15
    tracking_gap_share: float = 0.20
    # Real spend tables carry is_simulated = false; switch the rule off for them.
    require_simulated_spend: bool = True
    allowed_years: tuple[int, ...] = fv.ALLOWED_YEARS
    # A response is retried this many times before the template takes over.
    max_retries: int = 1

    def __post_init__(self) -> None:
        if self.start_date > self.end_date:
            raise ValueError("start_date must not be after end_date")
