"""Column-level helpers (all JVM-side ``Column`` expressions)."""

from marketlake.functions.columns import (  # noqa: F401
    canonical_share_class,
    cents_to_dollars,
    col_or_null,
    date_to_epoch_seconds,
    epoch_seconds_to_date,
    epoch_seconds_to_ts,
    normalize_symbol,
    ntz_lit,
    round_to_long,
    safe_divide,
    surrogate_key,
    ts_text,
    utc_date,
    utc_wall_clock,
)
from marketlake.functions.sectors import SECTORS, SECTOR_RULES, classify_sector  # noqa: F401
