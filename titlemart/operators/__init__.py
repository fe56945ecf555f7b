from titlemart.operators.arrays import (
    any_element_has,
    collect_aligned,
    collect_distinct,
    distinct_lists,
    unnest,
    unnest_product,
    unnest_structs,
)
from titlemart.operators.compare import reconcile, same_count
from titlemart.operators.topk import top_k_lists, top_k_per_group

__all__ = [
    "any_element_has",
    "collect_aligned",
    "collect_distinct",
    "distinct_lists",
    "reconcile",
    "same_count",
    "top_k_lists",
    "top_k_per_group",
    "unnest",
    "unnest_product",
    "unnest_structs",
]
