"""Reorder policy formulas."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelftide.params import PolicyParams

DECIMALS = 4
ROUNDED = ("safety_stock", "reorder_point", "target_stock_level", "recommended_order_qty", "days_of_supply")


def policy_columns(
    policy: PolicyParams,
    mean_demand: str = "avg_daily_demand",
    demand_std: str = "demand_std_dev",
    stock: str = "current_inventory_level",
) -> dict[str, Column]:
    """Safety stock, reorder point, target level, order quantity, days of supply, flag; not rounded.

    Days of supply is NULL without demand.
    """
    mean, on_hand = F.col(mean_demand), F.col(stock)
    buffer = F.col(demand_std) * (policy.service_level_z * math.sqrt(policy.lead_time_days))
    trigger = mean * policy.lead_time_days + buffer
    target = mean * policy.order_cycle_days + buffer
    shortfall = target - on_hand
    return {
        "safety_stock": buffer,
        "reorder_point": trigger,
        "target_stock_level": target,
        "recommended_order_qty": F.when(shortfall.isNotNull(), F.greatest(shortfall, F.lit(0.0))),
        "days_of_supply": F.when(mean > 0, on_hand / mean),
        "reorder_recommendation": on_hand <= trigger,
    }


def service_level_percent(z: float) -> float:
    """Share of demand periods covered by a safety factor under a normal distribution."""
    return 100 * (0.5 + 0.5 * math.erf(z / math.sqrt(2)))
