"""Settings, column names and interval tables; passed explicitly, never global."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Names of the data model, as the stored tables have them.
PROJECT, HOUSE, TIME = "ProjectIdBSV", "HuisIdBSV", "ReadingDate"
CUMULATIVE_COLUMNS = (
    "ElektriciteitNetgebruikHoog",
    "ElektriciteitNetgebruikLaag",
    "ElektriciteitTerugleveringHoog",
    "ElektriciteitTerugleveringLaag",
    "Gasgebruik",
    "ElektriciteitsgebruikWTW",
    "ElektriciteitsgebruikWarmtepomp",
    "ElektriciteitsgebruikBooster",
    "ElektriciteitsgebruikBoilervat",
    "ElektriciteitsgebruikRadiator",
    "WarmteproductieWarmtepomp",
    "WatergebruikWarmTapwater",
    "Zon-opwekTotaal",
)
AGGREGATION_COLUMNS = (
    "ElektriciteitNetgebruikHoogDiff",
    "ElektriciteitNetgebruikLaagDiff",
    "ElektriciteitTerugleveringHoogDiff",
    "ElektriciteitTerugleveringLaagDiff",
    "ElektriciteitsgebruikWTWDiff",
    "ElektriciteitsgebruikWarmtepompDiff",
    "ElektriciteitsgebruikBoosterDiff",
    "ElektriciteitsgebruikBoilervatDiff",
    "ElektriciteitsgebruikRadiatorDiff",
    "ZonopwekBruto",
    "TerugleveringTotaalNetto",
    "ElektriciteitsgebruikTotaalNetto",
    "Netuitwisseling",
    "ElektriciteitsgebruikTotaalWarmtepomp",
    "ElektriciteitsgebruikTotaalGebouwgebonden",
    "ElektriciteitsgebruikTotaalHuishoudelijk",
    "Zelfgebruik",
    "ElektriciteitsgebruikTotaalBruto",
)
# Minutes, readings of five minutes in a full bin, kWh per interval to kW.
MINUTES = {"5min": 5, "15min": 15, "60min": 60, "6h": 360, "24h": 1440}
FULL_BIN = {"5min": 1, "15min": 3, "60min": 12, "6h": 72, "24h": 288}
TO_KW = {"5min": 12.0, "15min": 4.0, "60min": 1.0, "6h": 1 / 6, "24h": 1 / 24}


@dataclass(frozen=True)
class Variable:
    """How a column is resampled in time and aggregated over households."""

    resample: str = "sum"
    aggregate: str = "avg"
    validator: str | None = None


VARIABLES: Mapping[str, Variable] = {c: Variable() for c in AGGREGATION_COLUMNS}


@dataclass(frozen=True)
class EngineConfig:
    mapped_folder_path: str = "./data/mapped"
    aggregate_folder_path: str = "./data/aggregate"
    weather_data_folder_path: str | None = None
    weather_stations_summary_file: str | None = None
    thresholds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    """Lower and upper bound by Diff column; columns without an entry have none."""
    excluded_project: int = 6


@dataclass(frozen=True)
class Keys:
    """Columns that identify a household's series; ties in time are broken by ``tie``."""

    project: str = PROJECT
    house: str = HOUSE
    time: str = TIME
    tie: tuple[str, ...] = ()

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tie]

    @property
    def entity(self) -> list[str]:
        return [self.project, self.house]


def minutes(interval: str) -> int:
    if interval not in MINUTES:
        raise ValueError(f"unknown interval {interval!r}; use one of {', '.join(MINUTES)}")
    return MINUTES[interval]
