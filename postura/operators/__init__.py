from postura.operators.any_key_join import any_key_join, row_keys
from postura.operators.distinct_counts import distinct_counts
from postura.operators.packing import pack, unpack
from postura.operators.skew import splittable_side
from postura.operators.spine import month_spine
from postura.operators.topk import first_per_key, top_per_key
from postura.operators.unpivot import labelled_rows

__all__ = [
    "any_key_join", "distinct_counts", "first_per_key", "labelled_rows", "month_spine", "pack", "row_keys", "splittable_side",
    "top_per_key", "unpack",
]
