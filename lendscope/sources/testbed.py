"""Lending-shaped wide loan rows derived from the driver's star schema.

One order is one loan. A borrower number ``bno`` equals the order key except
that every 40th order reuses the previous order's number, so some members hold
two loans (this is what the duplicate quarantine acts on). The borrower's
customer row is ``c_custkey = bno % (number of customers)``, so every customer
is used and two loans of one borrower share customer attributes.

Some cells are dirty, as in a hand-kept CSV: padded, blank or malformed values
(key columns too), and every 503rd borrower has no key value at all.

Plan shape: lineitem is pre-aggregated per order (partial + final aggregate,
one shuffle on ``l_orderkey``) before it meets orders; nation (25 rows by the
TPC-H definition) and customer are joined on equi-keys; no broadcast is
forced, so Spark broadcasts a side only when its measured size is under the
threshold (nation always is) and otherwise plans a sort-merge join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from lendscope.functions.keys import member_key
from lendscope.rules import MEMBER_KEY_COLUMNS
from lendscope.sources.tables import StarTables


def raw_loans(t: StarTables, repartition: int | None = None, member_partitions: int | None = None) -> DataFrame:
    """The wide loan table (37 source columns), one row per order. ``repartition``
    (default: none) deals the orders over that many partitions first;
    ``member_partitions`` deals the joined rows by member key, while they are narrow."""
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    o = o.repartition(repartition) if repartition else o
    ncust = t.customer.select(F.count(F.lit(1))).scalar()

    key = F.col("o_orderkey")
    bno = key - F.when((key % 40 == 0) & (key > 0), F.lit(1)).otherwise(F.lit(0))
    o = o.withColumns({"bno": bno}).withColumns({"cust_slot": F.col("bno") % ncust})

    # added up as whole cents: a long takes half the bytes of a decimal sum in the shuffle
    cents = (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(100)).cast("bigint")
    paid = (
        t.lineitem.groupBy("l_orderkey")
        .agg((F.sum(cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("double").alias("paid"))
    )
    cust = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = t.nation.select("n_nationkey", "n_name")

    j = (
        o.join(cust, o["cust_slot"] == cust["c_custkey"])
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(paid, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )

    b = F.col("bno")
    price = F.col("o_totalprice")
    paid0 = F.coalesce(F.col("paid"), F.lit(0.0))
    grade_letter = F.when(b % 97 == 0, F.lit("H")).otherwise(
        F.lit("ABCDEFG").substr((b % 7).cast("int") + 1, F.lit(1)))
    nine = b % 9
    null_d = F.lit(None).cast("double")
    null_s = F.lit(None).cast("string")

    cols = {
        "id": key.cast("string"),
        "emp_title": F.when(b % 101 == 0, null_s).otherwise(F.concat(F.lit("Borrower#"), b.cast("string"))),
        "emp_length": (
            F.when(b % 13 == 0, F.lit("n/a"))
            .when(b % 13 == 1, F.lit("< 1 year"))
            .when(b % 13 == 2, F.lit("10+ years"))
            .when(b % 13 == 3, null_s)
            .otherwise(F.concat((b % 13).cast("string"), F.lit(" years")))
        ),
        "home_ownership": (
            F.when(b % 53 == 0, null_s)
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("OWN"))
            .when(F.col("c_mktsegment") == "BUILDING", F.lit("RENT"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("MORTGAGE"))
            .when(F.col("c_mktsegment") == "FURNITURE", F.lit("ANY"))
            .otherwise(F.lit("OTHER"))
        ),
        "annual_inc": F.when(F.col("c_acctbal") < 0, null_d).otherwise(
            (F.col("c_acctbal").cast("decimal(12,2)") * F.lit(10)).cast("double")),
        "zip_code": F.concat((b % 1000).cast("string"), F.lit("xx")),
        "addr_state": (
            F.when(b % 31 == 0, null_s)
            .when(b % 29 == 0, F.col("n_name"))
            .otherwise(F.col("n_name").substr(1, 2))
        ),
        "grade": grade_letter,
        "sub_grade": F.concat(grade_letter, (b % 5 + 1).cast("string")),
        "verification_status": (
            F.when(b % 3 == 0, F.lit("Verified"))
            .when(b % 3 == 1, F.lit("Not Verified"))
            .otherwise(F.lit("Source Verified"))
        ),
        "tot_hi_cred_lim": F.when(nine == 0, null_d).otherwise(price * (F.lit(1) + nine * nine) / F.lit(2)),
        "application_type": F.when(b % 10 == 0, F.lit("Joint App")).otherwise(F.lit("Individual")),
        "annual_inc_joint": F.when(b % 10 == 0, F.lit(120000.0)).otherwise(null_d),
        "verification_status_joint": F.when(b % 10 == 0, F.lit("Not Verified")).otherwise(null_s),
        "loan_amnt": F.when(key % 61 == 0, null_d).otherwise(price),
        "funded_amnt": price,
        "term": F.when(key % 2 == 0, F.lit(" 36 months")).otherwise(F.lit(" 60 months")),
        "int_rate": (F.lit(5) + key % 20).cast("double"),
        "installment": price / F.lit(36),
        "issue_d": F.date_format(F.col("o_orderdate"), "MMM-yyyy"),
        "loan_status": (
            F.when(key % 8 == 0, F.lit("Fully Paid"))
            .when(key % 8 == 1, F.lit("Current"))
            .when(key % 8 == 2, F.lit("In Grace Period"))
            .when(key % 8 == 3, F.lit("Late (16-30 days)"))
            .when(key % 8 == 4, F.lit("Late (31-120 days)"))
            .when(key % 8 == 5, F.lit("Charged Off"))
            .when(key % 8 == 6, F.lit("Default"))
            .otherwise(F.lit("Does not meet the credit policy. Status:Fully Paid"))
        ),
        "purpose": (
            F.when(key % 6 == 0, F.lit("debt_consolidation"))
            .when(key % 6 == 1, F.lit("credit_card"))
            .when(key % 6 == 2, F.lit("car"))
            .when(key % 6 == 3, F.lit("wedding"))
            .when(key % 6 == 4, F.lit("pay my bills"))
            .otherwise(F.lit("Medical"))
        ),
        "title": F.col("o_orderpriority"),
        "total_rec_prncp": paid0 / F.lit(2),
        "total_rec_int": paid0 / F.lit(4),
        "total_rec_late_fee": (key % 4).cast("double"),
        "total_pymnt": (
            F.when(key % 50 == 1, F.lit(-5.0))
            .when(key % 10 == 0, F.lit(0.0))
            .otherwise(paid0)
        ),
        "last_pymnt_amnt": (
            F.when(key % 6 == 0, price / 36 * 0.25)
            .when(key % 6 == 1, price / 36 * 0.75)
            .when(key % 6 == 2, price / 36)
            .when(key % 6 == 3, price / 36 * 1.25)
            .when(key % 6 == 4, price / 36 * 2)
            .otherwise(F.when(key % 67 == 0, null_d).otherwise(F.lit(0.0)))
        ),
        "last_pymnt_d": F.when(key % 5 == 0, F.lit("0.0")).when(key % 5 == 1, null_s).otherwise(F.lit("Mar-2019")),
        "next_pymnt_d": F.when(key % 7 == 0, F.lit("0.0")).when(key % 7 == 1, null_s).otherwise(F.lit("Apr-2019")),
        "delinq_2yrs": F.when(b % 84 == 0, F.lit(0.0)).when(b % 8 == 7, null_d).otherwise((b % 8).cast("double")),
        "delinq_amnt": (b % 100).cast("double"),
        "pub_rec": F.when(b % 8 == 1, null_d).otherwise((b % 7).cast("double")),
        "pub_rec_bankruptcies": F.when(b % 84 == 0, F.lit(0.0)).otherwise(nine.cast("double")),
        "inq_last_6mths": F.when(b % 84 == 0, F.lit(0.0)).otherwise((b % 11).cast("double")),
        "mths_since_last_delinq": F.when(b % 3 == 0, F.lit(12.0)).otherwise(null_d),
        "mths_since_last_record": F.when(b % 4 == 0, F.lit(30.0)).otherwise(null_d),
    }
    cols = _dirty(cols, b, key)
    if member_partitions:
        j = j.repartition(member_partitions, member_key(*[cols[c] for c in MEMBER_KEY_COLUMNS]))
    return j.select(*[c.alias(n) for n, c in cols.items()])


def _dirty(cols: dict, b, key) -> dict:
    """Pad, blank or spoil some cells by borrower or order number."""
    def put(name, *cases):
        out = None
        for cond, value in cases:
            out = F.when(cond, value) if out is None else out.when(cond, value)
        cols[name] = out.otherwise(cols[name])

    cols = dict(cols) | {"annual_inc": cols["annual_inc"].cast("string")}
    pad = lambda name, left="", right="": F.concat(F.lit(left), cols[name], F.lit(right))
    put("emp_title", (b % 17 == 1, pad("emp_title", "  ", " ")))
    put("home_ownership", (b % 19 == 2, pad("home_ownership", "", " ")), (b % 19 == 3, F.lit("   ")))
    put("grade", (b % 23 == 4, pad("grade", " ")))
    put("sub_grade", (b % 23 == 4, pad("sub_grade", "", " ")))
    put("annual_inc", (b % 59 == 5, F.lit("n/a")), (b % 59 == 6, F.lit(" ")), (b % 59 == 7, pad("annual_inc", " ", " ")))
    put("verification_status", (b % 29 == 8, pad("verification_status", "\t")))
    put("loan_status", (key % 31 == 9, pad("loan_status", " ")))
    put("purpose", (key % 31 == 10, pad("purpose", "", " ")))
    put("title", (key % 37 == 0, F.lit("")))
    for name in MEMBER_KEY_COLUMNS:
        put(name, (b % 503 == 0, F.lit(None).cast("string")))
    return cols


def keyed_loans(raw: DataFrame, key_name: str = "name_sha2") -> DataFrame:
    """The wide table with the surrogate member key appended (P6)."""
    return raw.withColumns({key_name: member_key()})
