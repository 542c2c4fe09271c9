"""Settings of the signal and promotion steps."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SignalConfig:
    min_baseline: float = 100
    min_absolute_change: float = 10
    growth_percent: float = 5
    decline_percent: float = -5
    exclude_unspecified: bool = True
    exclude_totals: bool | str = True  #: "rows": total members of other dimensions are not summed with their parts, either
    exclude_small: bool = True
    logic_version: str = "1"
    importer_version: str = "unknown"
    has_signatures: bool = False  #: whether observations have observation_signature besides id


#: Keys of the time dimension, and phrases that mark unspecified and total categories.
TIME_KEYS = ("Tid", "tid", "TIME", "time")
UNSPECIFIED = ("uoppgitt", "unspecified", "unknown", "not stated", "ikke oppgitt")
TOTALS = ("i alt", "alle", "begge kjønn", "begge kjonn", "alle yrker", "alle næringer", "alle naeringer", "hele landet", "hele norge", "total", "nasjonalt")
#: What a promoted signal may be, and flags that block it.
PROMOTABLE = ("regional_education_employment_signal", "industry_education_employment_signal")
BLOCKING_FLAGS = ("unstable_slice", "preview_not_product_ready", "unspecified_category", "unspecified_dimension", "total_category")
