"""Retail demand analytics as lazy, distributed Spark DataFrame jobs."""

from shelftide.params import (
    EncodingParams,
    FeatureParams,
    OutputParams,
    PanelColumns,
    PolicyParams,
    Settings,
    SplitParams,
    TreeParams,
)

__all__ = [
    "EncodingParams",
    "FeatureParams",
    "OutputParams",
    "PanelColumns",
    "PolicyParams",
    "Settings",
    "SplitParams",
    "TreeParams",
]
