"""DataFrame operators: block use, flat-rate items, metered usage, bill lines, the
transaction table, the rate class, and skew-aware join strategies."""
