"""Source schemas of the billing history tables.

The source query ships no DDL, so every type here is inferred from how the column is
used: ids are longs, codes are ints, money is decimal(18,4), Oracle DATE (which carries a
time of day) is ``timestamp_ntz``, and two integer date encodings exist side by side
(``YYYYMMDD`` and ``MMDDYYYY`` without a leading zero).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


L, I, S, TS = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()

SCHEMAS: dict[str, T.StructType] = {
    "ciconsumptionhistblock": _schema(
        ("consumptionhistid", L), ("readsequence", L), ("blocknumber", I),
        ("blockusage", MONEY), ("blockamount", MONEY), ("blockrate", MONEY),
    ),
    "ciconsumptionhist": _schema(
        ("accountnumber", L), ("consumptionhistid", L), ("readsequence", L),
        ("device", S), ("devicecode", I), ("billdate", TS), ("hasblocks", I),
        ("numberofdays", I), ("fromdate", TS), ("todate", TS), ("rate1", I),
        ("ratekind1", I), ("servicenumbersequence", L), ("readingclass1", I),
        ("previousreaddate", TS), ("presentreaddate", TS), ("consumption", MONEY),
        ("billingamount", MONEY), ("transactioncode", I),
    ),
    "fwacmas": _schema(
        ("wacm_cust", L), ("wacm_address_seq_no", I), ("wacm_occupant_cis_no", L),
        ("wacm_premise_no", L), ("wacm_ref_acct", L), ("wacm_no_units", I),
    ),
    # cihis_date is YYYYMMDD; cihis_from_date / cihis_to_date are MMDDYYYY.
    "fcihistv": _schema(
        ("cihis_cust", L), ("cihis_date", I), ("cihis_service", L),
        ("cihis_class_num1", I), ("cihis_rate1", I), ("cihis_from_date", I),
        ("cihis_to_date", I), ("cihis_amt", MONEY), ("cihis_type_code", I),
        ("cihis_class_type1", I),
    ),
    "fcihistf": _schema(
        ("cihis_cust", L), ("cihis_date", I), ("cihis_code", I), ("cihis_reference", L),
    ),
    "cibillableitem": _schema(
        ("customernumber", L), ("servicenumber", L), ("dateiteminstalled", TS),
        ("itemremovaldate", TS),
    ),
    "wawatercustomermaster": _schema(
        ("customernumber", L), ("cisnumberofbilledaccount", L), ("premisenumber", L),
    ),
    "fciregister": _schema(
        ("ciregister_device", S), ("ciregister_device_cd", I), ("ciregister_num", I),
        ("ciregister_cmp_size", I),
    ),
    "ciratemaster": _schema(
        ("ratemasterid", L), ("ratekindid", I), ("rate", I), ("description", S),
        ("application", I),
    ),
    "ciratekind": _schema(("ratekindid", I), ("description", S)),
    "ciratedetail": _schema(
        ("ratemasterid", L), ("ratedetailid", L), ("effectivedate", TS),
        ("billingdescription", S), ("steprateid", L),
    ),
    "ciitemratedetail": _schema(("ratedetailid", L), ("itemcode", L), ("comments", S)),
    "ciitemcode": _schema(("itemcode", L), ("application", I), ("description", S)),
    "cisteprate": _schema(("application", I), ("steprateid", L), ("description", S)),
}

TABLE_NAMES: tuple[str, ...] = tuple(SCHEMAS)
