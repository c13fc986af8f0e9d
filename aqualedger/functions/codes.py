"""Business codes and classification rules.

Each classification is kept as ordered data (first match wins, like SQL ``CASE``) and
folded into a single ``when`` chain, so it is evaluated JVM-side with no UDF and no
lookup join.

A rule term is either an int (``rate = v``) or an inclusive ``(lo, hi)`` pair
(``rate BETWEEN lo AND hi``); a list of terms is OR-ed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Term = int | tuple[int, int]

# ---------------------------------------------------------------------------------------
# These must equal the source system's codes and rules exactly.
# ---------------------------------------------------------------------------------------

TXN_BLOCK_HEADER = 102   # consumption header billed in blocks
TXN_READING = 2          # meter reading
CLASS_TYPE_SALES = 4     # cihis_class_type1: sales
TYPE_ITEM_RECORD = 34    # cihis_type_code: item record
TYPE_TOTAL_BILLING = 95  # cihis_type_code: total billing record (period start and end)
CODE_BILLING_RECORD = 99  # cihis_code: billing record
SIZE_REGISTER = 1        # ciregister_num whose size is the service size
RATE_APPLICATION = 3     # ciratemaster.application used for the rate class

# Service size of a flat-rate item, by item rate (first match wins).
ITEM_SIZE_RULES: list[tuple[list[Term], str]] = [
    ([1, 2, 10, 20, 110, 201, 210], "0075"),
    ([3, 11, 21, 202], "0100"),
    ([22], "0125"),
    ([4, 12, 23, 203], "0150"),
    ([5, 13, 24, 111, 204], "0200"),
    ([6, 14, 25, 112, 205, 210], "0300"),
    ([7, 15, 26, 114, 206, 220], "0400"),
    ([8, 16, 27, 114, 230], "0600"),
    ([17, 28, 115, 240], "0800"),
    ([18, 29, 116, 250], "1000"),
    ([30, 260], "1200"),
]
ITEM_SIZE_DEFAULT = "9999"

# Service size of a metered service, by register size code.
REGISTER_SIZE_RULES: list[tuple[list[Term], str]] = [
    ([1], "00625"),
    ([2], "0075"),
    ([3], "0100"),
    ([13], "0125"),
    ([4], "0150"),
    ([5], "0200"),
    ([6], "0300"),
    ([7], "0400"),
    ([8], "0600"),
    ([9], "0800"),
    ([10], "1000"),
    ([11], "1200"),
    ([12], "1600"),
]
REGISTER_SIZE_DEFAULT = "9999"

# Utility type by (rate kind, rate): W water, D ditch, U multi-unit flat, F fire,
# B backflow; no match gives NULL.
UTILITY_TYPE_RULES: list[tuple[int, list[Term], str]] = [
    (0, [(1, 2500)], "W"),
    (0, [2502], "D"),
    (2, [(1, 19), 100], "U"),
    (2, [(20, 31), (110, 116), (210, 260)], "F"),
    (2, [40, 41], "D"),
    (2, [50], "B"),
]

# Rate schedule of metered water service (rate kind 0, rate 1..2500), by rate.
WATER_SCHEDULE: list[tuple[list[Term], str]] = [
    ([1], "RMWS"),
    ([10], "MMWS"),
    ([20], "GMW75"),
    ([21], "GMW01"),
    ([22], "GMW15"),
    ([23], "GMW02"),
    ([24], "GMW03"),
    ([25], "GMW04"),
    ([26], "GMW06"),
    ([27], "GMW08"),
    ([28], "GMW10"),
    ([30], "MIS"),
    ([40], "NPSU"),
    ([41], "NPST"),
    ([50], "IWS"),
    ([51], "IWSU"),
    ([52], "IWST"),
    ([60], "LVS"),
    ([70], "FSRP"),
    ([100], "RMWG"),
    ([110], "GOVS"),
    ([111], "GOVL"),
    ([112], "COMS"),
    ([113], "COML"),
    ([120], "MISG"),
    ([200], "RMWD1"),
    ([201], "RMWD2"),
    ([202], "MMWD"),
    ([203], "GMWD"),
    ([204], "MISD"),
    ([210], "FPSD-DU"),
    ([900], "NO BILL"),
    ([2500], "ITEM DRIVER"),
]

# Rate schedule: an outer rule on (rate kind, rate ranges), then an inner rule on rate.
RATE_SCHEDULE_RULES: list[tuple[int, list[Term], list[tuple[list[Term], str]]]] = [
    (0, [(1, 2500)], WATER_SCHEDULE),
    (2, [(1, 19), 100], [([1], "SUFR"), ([(2, 9)], "MRFS"), ([(10, 19)], "MRIS"), ([100], "RFWG")]),
    (2, [(20, 31), (110, 116), (210, 260)], [([(20, 31)], "FPST"), ([(110, 116)], "FPSG"), ([(210, 260)], "FPSD")]),
    (2, [40, 41, 50], [([40, 41], "DITCH"), ([50], "Backflow")]),
]

# ---------------------------------------------------------------------------------------


def matches(c: Column, terms: Sequence[Term]) -> Column:
    """OR of the terms: points become one ``isin``, pairs become ``between``."""
    points = [t for t in terms if isinstance(t, int)]
    preds = [c.between(lo, hi) for lo, hi in (t for t in terms if not isinstance(t, int))]
    if points:
        preds.insert(0, c.isin(points) if len(points) > 1 else c == points[0])
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def case_of(branches: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Fold ordered ``(predicate, value)`` pairs into one first-match ``when`` chain."""
    expr = None
    for pred, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(pred, v) if expr is None else expr.when(pred, v)
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def _by_terms(c: Column, rules: Sequence[tuple[Sequence[Term], str]], default: str | None) -> Column:
    return case_of([(matches(c, terms), label) for terms, label in rules], default)


def item_service_size(rate: Column | str) -> Column:
    """Service size of a flat-rate item; unknown or NULL rate gives '9999'."""
    c = F.col(rate) if isinstance(rate, str) else rate
    return _by_terms(c, ITEM_SIZE_RULES, ITEM_SIZE_DEFAULT)


def register_service_size(size_code: Column | str) -> Column:
    """Service size of a meter; unknown size or no register gives '9999'."""
    c = F.col(size_code) if isinstance(size_code, str) else size_code
    return _by_terms(c, REGISTER_SIZE_RULES, REGISTER_SIZE_DEFAULT)


def utility_type(kind: Column | str, rate: Column | str) -> Column:
    k = F.col(kind) if isinstance(kind, str) else kind
    r = F.col(rate) if isinstance(rate, str) else rate
    return case_of([((k == kk) & matches(r, terms), label) for kk, terms, label in UTILITY_TYPE_RULES])


def rate_schedule(kind: Column | str, rate: Column | str) -> Column:
    k = F.col(kind) if isinstance(kind, str) else kind
    r = F.col(rate) if isinstance(rate, str) else rate
    return case_of(
        [((k == kk) & matches(r, terms), _by_terms(r, inner, None)) for kk, terms, inner in RATE_SCHEDULE_RULES]
    )
