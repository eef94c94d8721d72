"""Typed settings.

Every operator takes the settings it needs as an argument; nothing is read from a
global. ``Settings.from_mapping`` accepts the sectioned mapping that a YAML config
file holds, so an existing config can be reused with ``yaml.safe_load``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

# Label order per nominal column. The position is the label.
LABEL_VALUES: dict[str, tuple[str, ...]] = {
    "category": ("Clothing", "Electronics", "Furniture", "Groceries", "Toys"),
    "region": ("East", "North", "South", "West"),
    "weather_condition": ("Sunny", "Cloudy", "Rainy", "Snowy"),
    "seasonality": ("Spring", "Summer", "Autumn", "Winter"),
}

# Names of the label columns.
LABEL_OUTPUTS: dict[str, str] = {
    "category": "category_encoded",
    "region": "region_encoded",
    "weather_condition": "weather_encoded",
    "seasonality": "seasonality_encoded",
}
ID_OUTPUTS: dict[str, str] = {
    "store_id": "store_id_encoded",
    "product_id": "product_id_encoded",
}

# Accepted ranges of the raw measures (both ends included).
VALUE_RANGES: dict[str, tuple[float, float]] = {
    "inventory_level": (50, 500),
    "units_sold": (0, 499),
    "units_ordered": (20, 200),
    "demand_forecast": (-9.99, 518.55),
    "price": (10.0, 100.0),
    "discount": (0, 20),
    "competitor_pricing": (5.03, 104.94),
}


@dataclass(frozen=True)
class PanelColumns:
    """Names of the columns that give a sales panel its structure.

    A panel holds one row per entity and day, so a single series can never be longer
    than the number of days covered: that is what bounds the size of one window group.
    ``operators.checks.require_unique_grain`` tests it.
    """

    entity: tuple[str, ...] = ("store_id", "product_id")
    date: str = "date"
    target: str = "units_sold"
    baseline: str = "demand_forecast"
    prediction: str = "predicted_units_sold"
    stock: str = "inventory_level"
    category: str = "category"
    region: str = "region"

    @property
    def grain(self) -> tuple[str, ...]:
        return (self.date, *self.entity)


@dataclass(frozen=True)
class EncodingParams:
    labels: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(LABEL_VALUES))
    label_outputs: Mapping[str, str] = field(default_factory=lambda: dict(LABEL_OUTPUTS))
    id_outputs: Mapping[str, str] = field(default_factory=lambda: dict(ID_OUTPUTS))
    # Up to this many distinct ids (about 100 bytes each) the id dimension is ranked in
    # one task and broadcast; above it, both steps stay distributed.
    broadcast_ids: int = 100_000

    def __post_init__(self) -> None:
        absent = [c for c in self.label_outputs if c not in self.labels]
        if absent:
            raise KeyError(f"no label values configured for: {absent}")


@dataclass(frozen=True)
class FeatureParams:
    lags: tuple[int, ...] = (1, 7, 14, 28)
    rolling: tuple[int, ...] = (7, 14, 28)
    # True: the frame ends on the current row, so the target of the day is part of its
    # own rolling features. False: the frame ends on the row before (leak-free).
    include_current: bool = True
    # Rolling mean and std of whole numbers from exact running sums instead of from each frame.
    running_sums: bool = True
    calendar: bool = True
    price: bool = True

    def __post_init__(self) -> None:
        bad = [n for n in (*self.lags, *self.rolling) if not isinstance(n, int) or n < 1]
        if bad:
            raise ValueError(f"window lengths must be positive integers, got {bad}")


@dataclass(frozen=True)
class SplitParams:
    """``rule`` "days" holds out the last ``holdout_days`` days; "percentile" trains up to the
    date at the ``train_share`` percentile of the rows."""

    holdout_days: int = 90
    train_share: float = 0.8
    rule: str = "days"
    seed: int = 42

    def __post_init__(self) -> None:
        if self.rule not in ("days", "percentile"):
            raise ValueError(f"unknown split rule: {self.rule}")


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings under their usual names.

    ``max_bins`` counts the bin of absent values and is 256 at most. After every ``checkpoint_interval`` trees the
    forecasts so far are staged.
    """

    n_estimators: int = 300
    max_depth: int = 6
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_weight: int = 5
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    objective: str = "reg:squarederror"
    eval_metric: str = "rmse"
    tree_method: str = "hist"
    max_bins: int = 256
    checkpoint_interval: int = 10

    def __post_init__(self) -> None:
        if self.objective != "reg:squarederror":
            raise ValueError(f"only squared-error regression is supported, got {self.objective}")
        if (self.tree_method, self.eval_metric) != ("hist", "rmse"):
            raise ValueError(f"only hist trees measured by rmse are supported, got {self.tree_method} and {self.eval_metric}")
        if not 3 <= self.max_bins <= 256:
            raise ValueError(f"max_bins must be 3 to 256, got {self.max_bins}")


@dataclass(frozen=True)
class PolicyParams:
    lead_time_days: int = 7
    order_cycle_days: int = 30
    service_level_z: float = 1.65


@dataclass(frozen=True)
class OutputParams:
    forecast_name: str = "demand_forecast"
    inventory_name: str = "inventory_recommendations"
    write_parquet: bool = True
    write_csv: bool = True


def _known(section: str, values: Mapping[str, Any], kind: type) -> Mapping[str, Any]:
    """``values``, if every key is a setting of ``kind``."""
    unknown = sorted(set(values) - {f.name for f in fields(kind)})
    if unknown:
        raise ValueError(f"unknown settings in section {section}: {unknown}")
    return values


@dataclass(frozen=True)
class Settings:
    panel: PanelColumns = field(default_factory=PanelColumns)
    encoding: EncodingParams = field(default_factory=EncodingParams)
    features: FeatureParams = field(default_factory=FeatureParams)
    split: SplitParams = field(default_factory=SplitParams)
    trees: TreeParams = field(default_factory=TreeParams)
    policy: PolicyParams = field(default_factory=PolicyParams)
    output: OutputParams = field(default_factory=OutputParams)

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any]) -> "Settings":
        """Settings from a sectioned config mapping; absent keys keep their defaults."""
        encoding = config.get("encoding")
        feature = config.get("feature_engineering", {})
        training = config.get("training", {})
        output = config.get("output", {})
        tree = _known("model.xgboost", config.get("model", {}).get("xgboost", {}), TreeParams)
        policy = _known("inventory", config.get("inventory", {}), PolicyParams)
        defaults = FeatureParams()
        return cls(
            encoding=EncodingParams()
            if encoding is None
            else EncodingParams(labels={c: tuple(group["values"]) for c, group in encoding.items()}),
            features=FeatureParams(
                lags=tuple(feature.get("lag_windows", defaults.lags)),
                rolling=tuple(feature.get("rolling_windows", defaults.rolling)),
                calendar=bool(feature.get("enable_calendar_features", True)),
                price=bool(feature.get("enable_price_features", True)),
            ),
            split=SplitParams(
                holdout_days=int(training.get("holdout_days", 90)),
                rule=training.get("split_rule", "days"),
                seed=int(training.get("random_seed", 42)),
            ),
            trees=TreeParams(**tree),
            policy=PolicyParams(**policy),
            output=OutputParams(
                forecast_name=output.get("forecast_filename", "demand_forecast"),
                inventory_name=output.get("inventory_filename", "inventory_recommendations"),
                write_parquet=bool(output.get("write_parquet", True)),
                write_csv=bool(output.get("write_csv", True)),
            ),
        )
