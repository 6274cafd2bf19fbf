"""The original module's three flows as single lazy plans.

* ``prepare_features``: calendar -> price sensitivity -> tier -> tier/welfare
  encoders -> welfare flags -> renames -> weather, chained by ``transform``;
  one plan, no UDF, no collect.
* ``branch_weather``: latest station weather -> nearest station per store.
* ``score_and_report``: two-stage scoring then the band report in one job.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame

from bandwise.functions.calendar import add_welfare_day_flag, encode_calendar, encode_tier, encode_welfare, rename_parts
from bandwise.operators.enrich import (
    join_price_sensitivity,
    join_tier,
    join_weather,
    price_sensitivity_dim,
    tier_dim,
    welfare_branch_flag,
)
from bandwise.operators.evaluate import range_report
from bandwise.operators.models import two_stage_score
from bandwise.operators.weather import map_weather_to_store, store_location, weather_latest


def branch_weather(
    store_raw: DataFrame, weather: DataFrame, stations: DataFrame, country: str = "TH", year: int | None = None, k: int = 1
) -> DataFrame:
    """(BranchCode, name, temp) of each store's nearest station on that station's latest day."""
    return map_weather_to_store(store_location(store_raw), weather_latest(weather, stations, country, year), k=k)


def prepare_features(
    sales: DataFrame,
    ps_raw: DataFrame,
    tier_raw: DataFrame,
    welfare: DataFrame,
    weather_by_branch: DataFrame | None = None,
    how: str = "left",
    salt: int = 0,
) -> DataFrame:
    """``salt > 1`` spreads hot (branch, material) keys of the two fact-sized joins."""
    df = (
        encode_calendar(sales)
        .transform(lambda d: join_price_sensitivity(d, price_sensitivity_dim(ps_raw), how, salt=salt))
        .transform(lambda d: join_tier(d, tier_dim(tier_raw), how, salt=salt))
        .transform(encode_tier)
        .transform(encode_welfare)
        .transform(lambda d: welfare_branch_flag(d, welfare))
        .transform(add_welfare_day_flag)
        .transform(rename_parts)
    )
    if weather_by_branch is not None:
        df = join_weather(df, weather_by_branch, how)
    return df


def score_and_report(
    sales: DataFrame, classifier: Transformer, regressor: Transformer, label: str = "TotalQtySale"
) -> DataFrame:
    return range_report(two_stage_score(sales, classifier, regressor), label=label, pred="pred_final")
