"""Industry -> sector classification (ordered, first match wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eleven accepted sector names.
SECTORS = [
    "Technology",
    "Healthcare",
    "Financials",
    "Consumer Discretionary",
    "Consumer Staples",
    "Industrials",
    "Energy",
    "Communication Services",
    "Utilities",
    "Real Estate",
    "Materials",
]

# Ordered (substring of lower-cased industry, sector) rules.
# Order matters: "biotechnology" hits "technology" first; "utilities" does not
# contain "utility" and falls through to the default.
SECTOR_RULES = [
    ("technology", "Technology"),
    ("health", "Healthcare"),
    ("pharma", "Healthcare"),
    ("biotech", "Healthcare"),
    ("bank", "Financials"),
    ("insurance", "Financials"),
    ("financial", "Financials"),
    ("consumer cyclical", "Consumer Discretionary"),
    ("retail", "Consumer Discretionary"),
    ("automobile", "Consumer Discretionary"),
    ("restaurant", "Consumer Discretionary"),
    ("consumer defensive", "Consumer Staples"),
    ("beverage", "Consumer Staples"),
    ("household", "Consumer Staples"),
    ("industrial", "Industrials"),
    ("aerospace", "Industrials"),
    ("transport", "Industrials"),
    ("energy", "Energy"),
    ("oil", "Energy"),
    ("gas", "Energy"),
    ("communication", "Communication Services"),
    ("media", "Communication Services"),
    ("entertainment", "Communication Services"),
    ("telecom", "Communication Services"),
    ("utility", "Utilities"),
    ("real estate", "Real Estate"),
    ("material", "Materials"),
    ("chemical", "Materials"),
]
DEFAULT_SECTOR = "Financials"


def classify_sector(industry: Column | str, rules=SECTOR_RULES, default: str = DEFAULT_SECTOR) -> Column:
    """One CASE expression: first rule whose pattern occurs in the industry."""
    ind = F.lower(F.coalesce(F.col(industry) if isinstance(industry, str) else industry, F.lit("")))
    expr = None
    for pattern, sector in rules:
        cond = ind.contains(pattern)
        expr = F.when(cond, F.lit(sector)) if expr is None else expr.when(cond, F.lit(sector))
    return expr.otherwise(F.lit(default))
