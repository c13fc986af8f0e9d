"""Bill lines: flat-rate and metered lines under a billing record, de-duplicated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import CODE_BILLING_RECORD
from ..functions.datekeys import DateKey, in_months, in_window
from .joins import split_join

# The 15 line columns, by position; names come from the flat-rate branch.
LINE_SCHEMA = T.StructType(
    [
        T.StructField("cihis_cust", T.LongType()),
        T.StructField("cihis_date", T.IntegerType()),
        T.StructField("cihis_service", T.LongType()),
        T.StructField("cihis_class_num1", T.IntegerType()),
        T.StructField("cihis_rate1", T.IntegerType()),
        T.StructField("ssize", T.StringType()),
        T.StructField("serviceconnectdate", T.IntegerType()),
        T.StructField("serviceclosedate", T.IntegerType()),
        T.StructField("days", T.DoubleType()),  # whole days for items, fractional for readings
        T.StructField("fromdate", T.IntegerType()),
        T.StructField("todate", T.IntegerType()),
        T.StructField("cihis_reference", T.LongType()),  # bill id
        T.StructField("cisnumberofbilledaccount", T.LongType()),
        T.StructField("premisenumber", T.LongType()),
        T.StructField("totalcharges", T.DecimalType(28, 4)),
    ]
)
LINE_COLUMNS = [f.name for f in LINE_SCHEMA.fields]
BILL_KEYS = ["cihis_cust", "cihis_date"]
HEADER_COLUMNS = ["cihis_reference", "cisnumberofbilledaccount", "premisenumber"]  # from the billing record
OWN_SCHEMA = T.StructType([f for f in LINE_SCHEMA.fields if f.name not in HEADER_COLUMNS])


def _as_line(df: DataFrame) -> DataFrame:
    """Pick and order the line columns by name and cast them to the line types."""
    return df.select(*LINE_COLUMNS).to(LINE_SCHEMA)


def bill_headers(
    histf: DataFrame,
    customers: DataFrame,
    start_key: DateKey | None = None,
    end_key: DateKey | None = None,
) -> DataFrame:
    """Billing records (code 99) with the customer's CIS number and premise.  Built once
    and shared by both branches; a customer listed twice fans out here."""
    hf = histf.where(F.col("cihis_code") == CODE_BILLING_RECORD)
    if start_key is not None:
        hf = in_months(hf, start_key, end_key).where(in_window("cihis_date", start_key, end_key))
    hf = hf.select("cihis_cust", "cihis_date", "cihis_reference")
    wcm = customers.select("customernumber", "cisnumberofbilledaccount", "premisenumber")
    return hf.join(wcm, F.col("cihis_cust") == F.col("customernumber"), "left").drop("customernumber")


def item_lines(items: DataFrame) -> DataFrame:
    """The line columns of flat-rate items that do not come from the billing record."""
    return items.select(*OWN_SCHEMA.names).to(OWN_SCHEMA)


def metered_lines(usage: DataFrame) -> DataFrame:
    """The line columns of metered usage that do not come from the billing record.  CIS number
    and premise come from the billing record's customer, not from the usage row."""
    return usage.select(
        F.col("accountnumber").alias("cihis_cust"),
        F.col("billdate").alias("cihis_date"),
        F.col("servicenumbersequence").alias("cihis_service"),
        F.col("readingclass1").alias("cihis_class_num1"),
        F.col("rate1").alias("cihis_rate1"),
        "ssize",
        "serviceconnectdate",
        "serviceclosedate",
        "days",
        "fromdate",
        "todate",
        "totalcharges",
    ).to(OWN_SCHEMA)


def _under_headers(lines: DataFrame, headers: DataFrame, seat: str | None = None) -> DataFrame:
    """Each line under every billing record of its customer and date; a customer's many records
    of one date are dealt to seats, and as the seat is a key, the join has shuffles of its own in
    which AQE can split a customer's many lines.  With ``seat``, equal records count once, and a
    column of that name has the line's seat."""
    named = headers.select(*[F.col(k).alias(f"hf_{k}") for k in BILL_KEYS], *HEADER_COLUMNS)
    on = [(k, f"hf_{k}") for k in BILL_KEYS]
    return split_join(lines, named, on, "inner", copies="_times" if seat else None, seat=seat)


def bill_items_branch(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Billing records that have flat-rate items (outer join + not-null = inner join)."""
    return _as_line(_under_headers(item_lines(items), headers))


def bill_metered_branch(headers: DataFrame, usage: DataFrame) -> DataFrame:
    """Billing records that have metered usage."""
    return _as_line(_under_headers(metered_lines(usage), headers))


def bill_lines(headers: DataFrame, items: DataFrame, usage: DataFrame) -> DataFrame:
    """UNION (distinct) of both branches: duplicates within a branch collapse too.

    The branches meet the same billing records on the same keys, so their lines are united first
    and meet them in one join.  Equal lines have equal billing records, hence one seat: they are
    found where the join leaves them, without another shuffle of the whole lines."""
    both = _under_headers(item_lines(items).unionByName(metered_lines(usage)), headers, "_seat")
    return _as_line(both.select(*LINE_COLUMNS, "_seat").distinct())


def collapsed_lines(items_branch: DataFrame, metered_branch: DataFrame) -> DataFrame:
    """Diagnostic for the UNION's de-duplication: one row with the line count before and
    after it and the difference.  Equal lines are counted per group first (partial
    aggregation), so no line set is brought to one task or the driver."""
    per_line = items_branch.unionByName(metered_branch).groupBy(*LINE_COLUMNS).count()
    return per_line.agg(
        F.sum("count").alias("lines_before"),
        F.count(F.lit(1)).alias("lines_after"),
    ).withColumn("collapsed", F.col("lines_before") - F.col("lines_after"))
