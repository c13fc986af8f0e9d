"""Stand-in billing tables derived from the driver's TPC-H-style Parquet tables.

The driver's data has no utility-billing tables, so each source table gets a stand-in
with the same columns, defined as a projection (and, for two of them, a join) of the
given tables.  Every stand-in is lazy and grows with the input tables; the equivalent
SQL used by the DuckDB oracle lives in ``aqualedger.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.datekeys import date_key
from .landing import BillingTables

DEC = "decimal(18,4)"


def _mdy(ts: Column) -> Column:
    """A timestamp written as MMDDYYYY (an int, so no leading zero)."""
    return F.month(ts) * 1000000 + F.dayofmonth(ts) * 10000 + F.year(ts)


def _padded(c: Column) -> Column:
    return F.concat(F.lit(" "), c.cast("string"), F.lit(" "))


def standin_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    lineitem, orders = read("lineitem"), read("orders")
    customer, part = read("customer"), read("part")
    region, supplier = read("region"), read("supplier")
    li_ord = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    odate = F.col("o_orderdate")

    blocks = lineitem.select(
        F.col("l_orderkey").alias("consumptionhistid"),
        (F.col("l_suppkey") % 2).alias("readsequence"),
        F.col("l_linenumber").alias("blocknumber"),
        F.col("l_quantity").cast(DEC).alias("blockusage"),
        F.col("l_extendedprice").cast(DEC).alias("blockamount"),
        F.col("l_discount").cast(DEC).alias("blockrate"),
    )

    # Block-billed headers (code 102, and code 7 as noise) come from orders ...
    hist_headers = orders.select(
        F.col("o_custkey").alias("accountnumber"),
        F.col("o_orderkey").alias("consumptionhistid"),
        (F.col("o_orderkey") % 2).alias("readsequence"),
        F.col("o_orderpriority").alias("device"),
        F.lit(0).alias("devicecode"),
        odate.alias("billdate"),
        F.lit(1).alias("hasblocks"),
        F.lit(30).alias("numberofdays"),
        odate.alias("fromdate"),
        (odate + F.expr("INTERVAL 30 DAYS")).alias("todate"),
        (F.col("o_custkey") % 300).alias("rate1"),
        F.lit(0).alias("ratekind1"),
        (F.col("o_orderkey") % 3).alias("servicenumbersequence"),
        F.lit(0).alias("readingclass1"),
        odate.alias("previousreaddate"),
        odate.alias("presentreaddate"),
        F.lit(None).cast(DEC).alias("consumption"),
        F.lit(None).cast(DEC).alias("billingamount"),
        F.when(F.col("o_orderstatus") == "P", 7).otherwise(102).alias("transactioncode"),
    )
    # ... and meter readings (code 2, and code 7 as noise) from order lines.
    even_line = F.col("l_linenumber") % 2 == 0
    # every third line is read twice: line 3 at the same bill time, line 6 three hours later;
    # some readings have no account
    read_on = F.when(even_line, odate + F.expr("INTERVAL 10 HOURS")).otherwise(odate)
    times = F.when(F.col("l_linenumber") % 3 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    hist_readings = li_ord.withColumn("copy", F.explode(times)).select(
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias("accountnumber"),
        F.col("o_orderkey").alias("consumptionhistid"),
        (F.col("o_orderkey") % 2).alias("readsequence"),
        _padded(F.col("l_partkey")).alias("device"),
        (F.col("l_linenumber") % 2).alias("devicecode"),
        F.when((F.col("l_linenumber") == 6) & (F.col("copy") == 2), read_on + F.expr("INTERVAL 3 HOURS")).otherwise(read_on).alias("billdate"),
        F.lit(0).alias("hasblocks"),
        F.lit(30).alias("numberofdays"),
        odate.alias("fromdate"),
        F.col("l_shipdate").alias("todate"),
        (F.col("l_partkey") % 300).alias("rate1"),
        F.lit(0).alias("ratekind1"),
        (F.col("o_orderkey") % 3).alias("servicenumbersequence"),
        F.col("l_linenumber").alias("readingclass1"),
        odate.alias("previousreaddate"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_shipdate") + F.expr("INTERVAL 12 HOURS"))
        .otherwise(F.col("l_shipdate"))
        .alias("presentreaddate"),
        (F.col("l_quantity") * F.col("copy")).cast(DEC).alias("consumption"),
        F.col("l_extendedprice").cast(DEC).alias("billingamount"),
        F.when(F.col("o_orderstatus") == "F", 7).otherwise(2).alias("transactioncode"),
    )

    # every seventh account has a second premise, every eleventh customer is listed twice
    seats = F.when(F.col("c_custkey") % 7 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    wacm = customer.withColumn("seat", F.explode(seats)).select(
        F.col("c_custkey").alias("wacm_cust"),
        F.col("seat").alias("wacm_address_seq_no"),
        F.col("c_nationkey").alias("wacm_occupant_cis_no"),
        F.expr("c_custkey div 300 + seat - 1").alias("wacm_premise_no"),
        F.col("c_custkey").alias("wacm_ref_acct"),
        F.lit(1).alias("wacm_no_units"),
    )
    listed = F.when(F.col("c_custkey") % 11 == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.sequence(F.lit(0), F.lit(0)))
    wcm = customer.withColumn("listing", F.explode(listed)).select(
        F.col("c_custkey").alias("customernumber"),
        (F.col("c_nationkey") + F.col("listing") * 100).alias("cisnumberofbilledaccount"),
        F.expr("c_custkey div 300").alias("premisenumber"),
    )
    register = part.select(
        _padded(F.col("p_partkey")).alias("ciregister_device"),
        (F.col("p_partkey") % 2).alias("ciregister_device_cd"),
        F.when(F.col("p_partkey") % 5 == 0, 2).otherwise(1).alias("ciregister_num"),
        F.col("p_size").alias("ciregister_cmp_size"),
    )
    returnflag = F.col("l_returnflag")
    histv = li_ord.select(
        F.col("o_custkey").alias("cihis_cust"),
        date_key(odate).alias("cihis_date"),
        (F.col("o_orderkey") % 3).alias("cihis_service"),
        F.col("l_linenumber").alias("cihis_class_num1"),
        (F.col("l_partkey") % 300).alias("cihis_rate1"),
        _mdy(odate).alias("cihis_from_date"),
        _mdy(F.col("l_shipdate")).alias("cihis_to_date"),
        F.col("l_extendedprice").cast(DEC).alias("cihis_amt"),
        F.when(returnflag == "R", 34).when(returnflag == "A", 95).otherwise(1).alias("cihis_type_code"),
        F.when(F.col("l_linestatus") == "O", 4).otherwise(1).alias("cihis_class_type1"),
    )
    histf = orders.select(
        F.col("o_custkey").alias("cihis_cust"),
        date_key(odate).alias("cihis_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(99).alias("cihis_code"),
        F.col("o_orderkey").alias("cihis_reference"),
    )
    items = orders.select(
        F.col("o_custkey").alias("customernumber"),
        (F.col("o_orderkey") % 3).alias("servicenumber"),
        odate.alias("dateiteminstalled"),
        F.when(F.col("o_orderpriority") == "1-URGENT", odate + F.expr("INTERVAL 365 DAYS"))
        .alias("itemremovaldate"),
    )
    ratemaster = part.select(
        F.col("p_partkey").alias("ratemasterid"),
        F.when(F.col("p_partkey") <= 600, F.col("p_partkey") % 2 * 2).otherwise(F.col("p_partkey") % 3).alias("ratekindid"),
        # the first 900 parts carry the coded rates, up to 300 of them under both kinds;
        # each other part has a rate of its own
        F.when(F.col("p_partkey") <= 600, F.expr("p_partkey div 2"))
        .when(F.col("p_partkey") > 900, 10000 + F.col("p_partkey"))
        .when(F.col("p_partkey") % 10 == 9, F.expr("2496 + p_partkey div 30 % 10"))
        .otherwise(F.col("p_partkey"))
        .alias("rate"),
        F.col("p_name").alias("description"),
        F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(3).alias("application"),
    )
    ratekind = region.select(
        F.col("r_regionkey").alias("ratekindid"), F.col("r_name").alias("description")
    )
    ratedetail = lineitem.select(
        F.col("l_partkey").alias("ratemasterid"),
        F.col("l_orderkey").alias("ratedetailid"),
        F.col("l_shipdate").alias("effectivedate"),
        F.when(F.col("l_linenumber") % 2 == 0, returnflag).alias("billingdescription"),
        F.col("l_suppkey").alias("steprateid"),
    )
    itemratedetail = orders.select(
        F.col("o_orderkey").alias("ratedetailid"),
        F.col("o_custkey").alias("itemcode"),
        F.col("o_orderpriority").alias("comments"),
    )
    itemcode = customer.select(
        F.col("c_custkey").alias("itemcode"),
        F.when(F.col("c_custkey") % 2 == 0, 3).otherwise(1).alias("application"),
        F.col("c_mktsegment").alias("description"),
    )
    steprate = supplier.select(
        F.col("s_suppkey").alias("steprateid"),
        F.lit(3).alias("application"),
        F.col("s_name").alias("description"),
    )
    return {
        "ciconsumptionhistblock": blocks,
        "ciconsumptionhist": hist_headers.unionByName(hist_readings),
        "fwacmas": wacm,
        "fcihistv": histv,
        "fcihistf": histf,
        "cibillableitem": items,
        "wawatercustomermaster": wcm,
        "fciregister": register,
        "ciratemaster": ratemaster,
        "ciratekind": ratekind,
        "ciratedetail": ratedetail,
        "ciitemratedetail": itemratedetail,
        "ciitemcode": itemcode,
        "cisteprate": steprate,
    }


def standin_tables(spark: SparkSession, sf_dir: str) -> BillingTables:
    """All fourteen stand-ins, conformed to the source schemas."""
    return BillingTables.from_mapping(standin_frames(spark, sf_dir))
