"""The driver's test tables bound to the library: one named query per operator, with its SQL.

Tables are read as trips: `orders` is the green service, `lineitem` the yellow one, `nation`
the zones, `events` the hourly facts and `documents` the nested records.
"""

from querybook import checks, nested, relational, reports, sinks, sources  # noqa: F401
from querybook.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
