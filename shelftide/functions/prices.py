"""Price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_columns(
    price: str = "price", discount: str = "discount", competitor: str = "competitor_pricing"
) -> dict[str, Column]:
    """Price after the percentage discount, price relative to the competitor's (NULL where
    that is 0 or NULL), and whether there is a discount at all."""
    return {
        "effective_price": F.col(price) * (1 - F.col(discount) / 100),
        "price_to_competitor_ratio": F.try_divide(F.col(price), F.col(competitor)),
        "has_discount": F.col(discount) > 0,
    }
