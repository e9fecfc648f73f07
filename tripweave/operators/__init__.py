from tripweave.operators.aggregates import (
    class_shares, counts_by, counts_of_columns, daily_counts, daily_totals, group_mode, numeric_profile,
    row_count, top_counts, usage_counts,
)
from tripweave.operators.asof import asof_join
from tripweave.operators.filters import (
    between_dates, implied_by_reading, in_list, inside_box, matching, message_box, with_both_ends_in,
)
from tripweave.operators.grid import all_combinations, distinct_pairs, near_pairs
from tripweave.operators.projections import cast_all_double, label_from_count, preview
from tripweave.operators.sets import (
    ids_missing_from, keep_largest, names_of, start_ids_never_ended, used_ids,
)

__all__ = [
    "all_combinations", "asof_join", "between_dates", "cast_all_double", "class_shares",
    "counts_by", "counts_of_columns", "daily_counts", "daily_totals", "distinct_pairs", "group_mode",
    "ids_missing_from", "implied_by_reading", "in_list", "inside_box", "keep_largest", "label_from_count",
    "matching", "message_box", "names_of", "near_pairs", "numeric_profile", "preview", "row_count",
    "start_ids_never_ended", "top_counts", "usage_counts", "used_ids", "with_both_ends_in",
]
