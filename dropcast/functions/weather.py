"""Weather column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import WEATHER_ENCODING, WEATHER_MULTIPLIER


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map_literal(d: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def weather_ordinal(cond="weather_condition") -> Column:
    """clear 0, cloudy 1, fog 2, rain 3, heavy_rain 4; unknown/NULL -> 0."""
    return F.coalesce(F.try_element_at(_map_literal(WEATHER_ENCODING), _c(cond)), F.lit(0)).cast("int")


def weather_multiplier(cond="weather_condition", default: float | None = 1.0) -> Column:
    m = F.try_element_at(_map_literal({k: float(v) for k, v in WEATHER_MULTIPLIER.items()}), _c(cond))
    return m if default is None else F.coalesce(m, F.lit(float(default)))


def weather_one_hot(vocabulary: list[str], cond="weather_condition", prefix: str = "weather") -> dict[str, Column]:
    """Dummy column per fitted category, alphabetically first dropped."""
    cats = sorted(v for v in vocabulary if v is not None)[1:]
    c = _c(cond)
    return {f"{prefix}_{v}": F.coalesce((c == F.lit(v)).cast("int"), F.lit(0)) for v in cats}
