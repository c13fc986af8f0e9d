"""Monthly utility-billing transaction table on Spark.

Pivot tiered consumption blocks, classify rates and service sizes, turn two integer
date encodings into one, sum flat-rate items and metered readings, unite both kinds of
bill line without duplicates, and attach tiered use, charges and rates by premise and
bill date for a date window.  Every step is a DataFrame function built from Spark
built-ins.
"""

from .functions.datekeys import date_range, window_keys
from .operators.transactions import transactions
from .sources.landing import BillingTables, conform, read_tables
from .sources.sinks import land_tables, write_months

__all__ = ["BillingTables", "conform", "date_range", "land_tables", "read_tables", "transactions", "window_keys", "write_months"]
