from medallion.functions.exprs import (  # noqa: F401
    count_where,
    hours_between,
    percent_of,
    safe_percent,
    weighted_count_where,
)
