from revtrace.functions.scalar import (
    missing_fields,
    normalize_state,
    round_ratio_half_away,
    transit_days,
)

__all__ = ["missing_fields", "normalize_state", "round_ratio_half_away", "transit_days"]
