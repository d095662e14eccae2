from tallyhouse.functions.columns import (  # noqa: F401
    day_before, month_start, norm_text, on_or_after, to_day, zero,
)
