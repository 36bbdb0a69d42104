from meterline.functions.base_ids import base_id, base_id_udf
from meterline.functions.clock import day_of, hour_start, hours_between, literal_like, month_start
from meterline.functions.measures import fixed_avg, fixed_sum
from meterline.functions.text import join_text

__all__ = [
    "base_id",
    "base_id_udf",
    "day_of",
    "fixed_avg",
    "fixed_sum",
    "hour_start",
    "hours_between",
    "join_text",
    "literal_like",
    "month_start",
]
