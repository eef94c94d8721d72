"""Reorder advice per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftide.functions.exact import deviation_of, mean_of, merged, moments, round_columns
from shelftide.functions.stock import DECIMALS, ROUNDED, policy_columns, service_level_percent
from shelftide.operators.checks import require_columns, unmatched_entities
from shelftide.params import PanelColumns, PolicyParams
from shelftide.schemas import RECOMMENDATION_MEASURES


def demand_stats(scored: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """Mean and sample standard deviation of the forecasts of each entity (0 for a single
    row), with its first category and region in date order. Entities with a NULL key are
    left out.

    Forecasts count in whole millionths, whose sums and sums of squares are exact: the figures are the same for any
    partitioning, and large forecasts lose no digits. The rows are aggregated with category and region as
    keys: only numbers are aggregated then, so Spark hashes where it would have to sort the rows to carry strings
    along. The few resulting groups of an entity add up.
    """
    require_columns(scored, [*panel.grain, panel.category, panel.region, panel.prediction], "demand statistics")
    parts = moments(F.col(panel.prediction))
    groups = (
        scored.dropna(subset=list(panel.entity))
        .groupBy(*panel.entity, panel.category, panel.region)
        .agg(*[c.alias(name) for name, c in parts.items()], F.min(panel.date).alias("first_day"))
    )

    def first(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.col("first_day"))).alias(column)

    entities = groups.groupBy(*panel.entity).agg(
        first(panel.category), first(panel.region), *[c.alias(name) for name, c in merged().items()]
    )
    return entities.select(
        *panel.entity,
        panel.category,
        panel.region,
        mean_of().alias("avg_daily_demand"),
        F.when(F.col("n") > 1, deviation_of()).otherwise(0.0).alias("demand_std_dev"),
    )


def latest_stock(df: DataFrame, panel: PanelColumns = PanelColumns(), check_ties: bool = False) -> DataFrame:
    """Stock on the latest date of each entity. An aggregate, so rows are reduced before
    the shuffle and nothing is sorted; ``latest_ties`` reports entities for which it is
    not defined. With ``check_ties`` the job fails for an entity whose latest rows differ in
    stock, which the same aggregate sees."""
    require_columns(df, [*panel.grain, panel.stock], "latest stock")
    stock, day = F.col(panel.stock), F.unix_date(panel.date).cast("double")
    # On numbers alone: the latest date with the largest and with the smallest stock.
    wide = F.lit(2.0**31)
    found = (
        df.dropna(subset=list(panel.entity))
        .groupBy(*panel.entity)
        .agg(
            F.max_by(panel.stock, panel.date).alias(panel.stock),
            *([F.max_by(stock, day * wide + stock).alias("__most"), F.max_by(stock, day * wide - stock).alias("__least")] if check_ties else []),
        )
    )
    if not check_ties:
        return found
    message = F.concat(F.lit("more than one latest stock row, for example "), F.concat_ws(", ", *[F.col(c).cast("string") for c in panel.entity]))
    ambiguous = F.col("__most") != F.col("__least")
    checked = F.when(ambiguous, F.raise_error(message).cast(found.schema[panel.stock].dataType)).otherwise(F.col(panel.stock))
    return found.select(*panel.entity, checked.alias(panel.stock))


def apply_policy(entities: DataFrame, policy: PolicyParams = PolicyParams()) -> DataFrame:
    """Policy figures to four places, with the policy values themselves for audit. The flag compares unrounded numbers."""
    figures = entities.withColumns(
        {
            "lead_time_days": F.lit(policy.lead_time_days),
            "order_cycle_days": F.lit(policy.order_cycle_days),
            "service_level_z": F.lit(float(policy.service_level_z)),
            **policy_columns(policy),
        }
    )
    return round_columns(figures, ROUNDED, DECIMALS)


def recommend(
    scored: DataFrame,
    features: DataFrame,
    policy: PolicyParams = PolicyParams(),
    panel: PanelColumns = PanelColumns(),
    check_ties: bool = True,
) -> DataFrame:
    """One row per entity that has both forecasts and stock, in key order.

    Both sides are grouped by the entity, so their join needs no further shuffle. With
    ``check_ties`` the job that reads the advice fails if the latest rows of an entity differ in stock.
    """
    entities = demand_stats(scored, panel).join(latest_stock(features, panel, check_ties), list(panel.entity), "inner")
    return (
        apply_policy(entities.withColumnRenamed(panel.stock, "current_inventory_level"), policy)
        .select(*panel.entity, panel.category, panel.region, *RECOMMENDATION_MEASURES)
        .orderBy(*panel.entity)
    )


def unmatched_count(demand: DataFrame, stock: DataFrame, panel: PanelColumns = PanelColumns()) -> DataFrame:
    """One row: the number of entities ``recommend`` leaves out for want of stock."""
    return unmatched_entities(demand, stock, panel).agg(F.count(F.lit(1)).alias("unmatched"))


def run_summary(
    scored: DataFrame,
    recommendations: DataFrame,
    policy: PolicyParams = PolicyParams(),
    panel: PanelColumns = PanelColumns(),
    unmatched: DataFrame | None = None,
) -> DataFrame:
    """Figures of a run as (subject, measure, value): rows per category, range and mean of
    the forecasts, means over the entities, flagged entities, service level, and, given the row of
    ``unmatched_count``, the entities without stock. The forecasts are read once: they are
    added up per category, and those few rows for the whole. Means come from exact sums."""

    def lines(rows: DataFrame, subject: str, measures: dict[str, Column], means: dict[str, str] = {}) -> DataFrame:  # noqa: B006
        sums = [c.alias(name) for m, column in means.items() for name, c in moments(F.col(column), prefix=f"{m}_").items()]
        counted = rows.agg(*[c.cast("double").alias(m) for m, c in measures.items()], *sums)
        measures = {**measures, **means}
        counted = counted.withColumns({m: mean_of(f"{m}_") for m in means}) if means else counted
        cells = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures]
        return counted.select(F.lit(subject).alias("subject"), F.inline(F.array(*cells)))

    flagged = F.count_if("reorder_recommendation")
    forecast = F.col(panel.prediction)
    groups = (
        scored.groupBy(F.col(panel.category).alias("measure"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(forecast).alias("least"), F.max(forecast).alias("most"), *[c.alias(name) for name, c in moments(forecast).items()])
    )
    # One row per category, folded into one row: its lines come out of a single pass.
    folded = groups.agg(
        F.collect_list(F.struct("measure", F.col("rows").cast("double").alias("value"))).alias("categories"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        *[c.alias(name) for name, c in merged().items()],
    ).withColumn("mean", mean_of())
    whole = F.array(
        *[
            F.struct(F.lit("forecast").alias("subject"), F.lit(m).alias("measure"), F.col(c).cast("double").alias("value"))
            for m, c in (("min", "least"), ("max", "most"), ("mean", "mean"))
        ]
    )
    by_category = F.transform(
        "categories", lambda c: F.struct(F.lit("category_rows").alias("subject"), c["measure"].alias("measure"), c["value"].alias("value"))
    )
    forecasts = folded.select(F.inline(F.concat(by_category, whole)))
    entities = lines(
        recommendations,
        "entities",
        {
            "count": F.count(F.lit(1)),
            "reorder_flagged": flagged,
            "reorder_flagged_pct": 100 * F.try_divide(flagged, F.count(F.lit(1))),
            "service_level_pct": F.max(F.lit(service_level_percent(policy.service_level_z))),
        },
        {"mean_daily_demand": "avg_daily_demand", "mean_demand_std_dev": "demand_std_dev"},
    )
    found = forecasts.unionByName(entities)
    if unmatched is None:
        return found
    return found.unionByName(lines(unmatched, "entities", {"without_stock": F.max("unmatched")}))
