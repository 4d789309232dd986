"""From daily and spend tables to KPIs, findings and facts of all weeks in one run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame

from tidemark.model import Settings
from tidemark.operators import anomalies as an
from tidemark.operators import facts as fa
from tidemark.operators import kpis, quality
from tidemark.plans.materialize import Scratch


@dataclass(frozen=True)
class Report:
    """Tables of one run. The properties are lazy plans over the stored tables."""

    settings: Settings
    scratch: Scratch
    flagged_daily: DataFrame
    flagged_spend: DataFrame
    daily: DataFrame
    weekly: DataFrame

    @property
    def quarantined_daily(self) -> DataFrame:
        return quality.split(self.flagged_daily)[1]

    @property
    def quarantined_spend(self) -> DataFrame:
        return quality.split(self.flagged_spend)[1]

    @property
    def quarantined_rows(self) -> Column:
        return fa.quarantined_count(self.quarantined_daily, self.quarantined_spend)

    @cached_property
    def anomalies(self) -> DataFrame:
        return an.detect_anomalies(self.daily, self.weekly, self.settings)

    @property
    def top_anomalies(self) -> DataFrame:
        return an.rank_anomalies(self.anomalies, self.settings.max_anomalies)

    def facts(self) -> DataFrame:
        """Facts of every complete week. The findings feed two branches, so they are stored."""
        found = self.scratch.keep(self.anomalies)
        return fa.weekly_facts(self.weekly, found, self.quarantined_rows, self.settings)

    def close(self) -> None:
        """Drop the stored tables; what was made from them must have been written before."""
        self.scratch.close()

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def prepare(
    daily: DataFrame, spend: DataFrame, settings: Settings, scratch: Scratch | None = None
) -> Report:
    """Validate both tables and derive the KPIs.

    Each table is read once, to be flagged. The flagged rows and the weekly table have several readers, so they
    are stored. Quarantine comes before the weeks, so a day whose rows all failed makes its week partial.
    """
    scratch = scratch or Scratch(daily.sparkSession)
    flagged_daily = scratch.keep(quality.flag_rows(quality.conform(daily, quality.DAILY, "daily"), quality.daily_rules(settings)))
    flagged_spend = scratch.keep(
        quality.flag_rows(quality.conform(spend, quality.spend_schema(settings), "spend"), quality.spend_rules(settings))
    )
    valid_daily, _ = quality.split(flagged_daily)
    valid_spend, _ = quality.split(flagged_spend)
    paid = settings.paid_channels
    weekly = kpis.with_changes(kpis.weekly_metrics(valid_daily, valid_spend, paid))
    return Report(
        settings=settings,
        scratch=scratch,
        flagged_daily=flagged_daily,
        flagged_spend=flagged_spend,
        daily=kpis.daily_metrics(valid_daily, valid_spend, paid),
        weekly=scratch.keep(weekly),
    )
