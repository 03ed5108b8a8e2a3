from wellmart.operators.joins import month_window, month_window_join, null_as_zero_on, zero_if_null  # noqa: F401
from wellmart.operators.lists import collect_items, distinct_list, prefixed, stuff_join  # noqa: F401
from wellmart.operators.measures import sum_by_unit  # noqa: F401
from wellmart.operators.ranking import dense_rank_by, latest_row, partition_agg, top_group  # noqa: F401
from wellmart.operators.setops import key_presence, keys_only_in, keys_only_in_each, union_all, union_distinct  # noqa: F401
