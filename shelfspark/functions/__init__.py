"""Column expressions and generic DataFrame helpers."""

from shelfspark.functions.columns import (  # noqa: F401
    activity_class, age_group, as_of_date, as_of_timestamp, content_match,
    digits_only, discount_percent, elapsed_days, interaction_weight, is_type,
    price_band, recency_decay,
)
from shelfspark.functions.frames import (  # noqa: F401
    assign_ids, histogram, latest_by, top_k, top_n, union_all,
)
