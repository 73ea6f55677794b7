"""Parameters of the two data flows, with the fixed values as defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from sparkmart import fixed_values as fv


@dataclass(frozen=True)
class WarehouseSettings:
    """Rules of the sales warehouse. ``as_of`` replaces "today" in every rule that needs it."""

    as_of: date | None = None
    vat_rate: str = fv.VAT_RATE
    statuses: dict[str, str] = field(default_factory=lambda: dict(fv.ORDER_STATUSES))
    sexes: dict[str, str] = field(default_factory=lambda: dict(fv.SEXES))
    categories: dict[str, str] = field(default_factory=lambda: dict(fv.CATEGORIES))
    city_variants: dict[str, str] = field(default_factory=lambda: dict(fv.CITY_VARIANTS))
    default_price: str = fv.DEFAULT_PRICE
    gold_from: int = fv.GOLD_FROM
    silver_from: int = fv.SILVER_FROM
    segment_days: int = fv.SEGMENT_DAYS
    late_after_days: int = fv.LATE_AFTER_DAYS
    calendar_start: str = fv.CALENDAR_START
    calendar_end: str = fv.CALENDAR_END
    # False: orders of a de-duplicated client id are dropped from the fact, as
    # the rules say. True: they follow the surviving client record.
    remap_merged_clients: bool = False
    # Clients and products keep their versions from load to load, in files by bucket of
    # their id; a load rewrites the buckets with changes. The number is fixed by the first load.
    dimension_buckets: int = 64
    # Loads (and refreshes of marts) whose files stay.
    keep_versions: int = 2


@dataclass(frozen=True)
class LakeSettings:
    """Rules of the job-offer lake."""

    profile_rules: list[tuple[str, str]] = field(default_factory=lambda: list(fv.PROFILE_RULES))
    other_profile: str = fv.OTHER_PROFILE
    eur_to_mad: float = fv.EUR_TO_MAD
    salary_floor: int = fv.SALARY_FLOOR
    salary_ceiling: int = fv.SALARY_CEILING
    top_employers: int = 100
    # Sketches per month, stored beside the marts, for approximate figures of any span.
    sketches: bool = False
    sketch_lg_k: int = 14
    sketch_k: int = 2000
