"""The consolidated view kept as factors.

A member's rows in the view are the product of its customer, loan, delinquency
and detail rows, so a member with very many of each makes the view many times
its inputs. Kept as factors, a member's rows of each table are arrays beside each
other, and the product is never formed: row counts and column sums follow from
the arrays and the lengths of the others, and ``expand`` gives the rows
themselves for the members one wants to see.

Equal entries of a member are held once, with their number ``n``. A factor row
holds at most about ``block`` entries of one table, so a member with very many
loans is several rows (``part``) and not one that outgrows a task; its entries
are dealt over the parts by their hash. Building shuffles each table by its
distinct entries (counted in the map first) and then by (member, part); totals
need one aggregation of small partial sums per member and no join of rows with
rows.

Cases: a member without customer rows is not in the view; a missing loan,
delinquency or detail entry counts as one row of NULLs, as in a left join; a
repayment is looked up by its loan id as in the view (several repayments of one
loan give several entries); a NULL member id matches nothing, so a customer row
without one stays alone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lendscope.operators.consolidate import (
    CUSTOMER_COLS, DELINQ_COLS, DETAIL_COLS, LOAN_COLS, REPAYMENT_COLS, VIEW_COLUMNS,
)

#: A column's value as an exact whole number, NULL counting as nothing.
Measure = Callable[[Column], Column]
#: Entries of one table in a factor row, about.
BLOCK = 1024
FACTORS = {
    # factor: the view's columns that it holds
    "customers": [c for c in CUSTOMER_COLS if c != "member_id"],
    "loans": ["loan_id", *LOAN_COLS, *REPAYMENT_COLS],
    "delinq": DELINQ_COLS,
    "details": DETAIL_COLS,
}


def _entries(df: DataFrame, factor: str, block: int) -> DataFrame:
    """(member_id, part, entries) of one table: its distinct rows as arrays of
    structs, dealt over as many parts as its member needs."""
    cols = FACTORS[factor]
    rows = (df.groupBy("member_id", *cols).agg(F.count(F.lit(1)).alias("n"))
            .select("member_id", F.struct(*cols, "n").alias("entry")))
    sizes = (rows.groupBy("member_id").agg(F.count(F.lit(1)).alias("entries")).where(F.col("entries") > block)
             .select(F.col("member_id").alias("__big"), F.ceil(F.col("entries") / block).alias("parts")))
    # only the members that large: the join's small side
    dealt = rows.join(sizes, F.col("member_id") == F.col("__big"), "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("entry"), F.col("parts")), F.lit(0)).cast("int"))
    return dealt.groupBy("member_id", "part").agg(F.collect_list("entry").alias(factor))


def factorise(customers: DataFrame, loans: DataFrame, repayments: DataFrame, delinq: DataFrame,
              details: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per member and part: member_id, part and an array of entries per
    factor (empty where the part has none), for members with a customer row."""
    paid = repayments.select("loan_id", *REPAYMENT_COLS)
    lent = loans.select("member_id", "loan_id", *LOAN_COLS).join(paid, "loan_id", "left")
    tables = {"customers": customers.select("member_id", *FACTORS["customers"]), "loans": lent, "delinq": delinq,
              "details": details}
    parts = []
    for name, df in tables.items():
        # only customers may lack an id: nothing else can meet them
        df = df if name == "customers" else df.where(F.col("member_id").isNotNull())
        one = _entries(df, name, block)
        types = {f: _array_type(tables[f], f) for f in FACTORS}
        # under a name of its own the id keeps the tables' partitioning by it
        parts.append(one.select(F.col("member_id").alias("__by"), "part", *[
            F.col(f) if f == name else F.lit(None).cast(types[f]).alias(f) for f in FACTORS]))
    stacked = reduce(lambda a, b: a.unionByName(b), parts)
    merged = stacked.groupBy("__by", "part").agg(*[
        F.coalesce(F.first(f, ignorenulls=True), F.array().cast(_array_type(tables[f], f))).alias(f) for f in FACTORS])
    merged = merged.withColumnRenamed("__by", "member_id")
    known = customers.select(F.col("member_id").alias("__known")).distinct()
    # rows without an id are customers' own; a plain equality needs no other partitioning
    return merged.join(known, F.col("member_id") == F.col("__known"), "left").where(
        F.col("member_id").isNull() | F.col("__known").isNotNull()).drop("__known")


def _array_type(df: DataFrame, factor: str) -> str:
    types = dict(df.dtypes)
    return "array<struct<" + ",".join(f"`{c}`:{types[c]}" for c in FACTORS[factor]) + ",n:bigint>>"


def _sizes() -> list[Column]:
    rows = lambda f: F.aggregate(f, F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])
    return [F.sum(rows(f)).cast("decimal(20,0)").alias(f"n_{f}") for f in FACTORS]


def _others(factor: str | None) -> Column:
    """Rows of the view for one entry of ``factor`` (None: for the member): the
    product of the other factors' sizes, a missing one counting as one row."""
    product = F.lit(1).cast("decimal(38,0)")
    for f in FACTORS:
        if f == factor:
            continue
        n = F.col(f"n_{f}")
        # nothing meets a member without an id, and every member here has a customer row
        n = n if f == "customers" else F.when(F.col("member_id").isNull(), 1).otherwise(F.greatest(n, F.lit(1)))
        product = (product * n).cast("decimal(38,0)")
    return product


def member_totals(factors: DataFrame, measures: dict[str, Measure] | None = None) -> DataFrame:
    """Per member: entries of each factor, ``n_rows`` of the view, and the sum of
    each measure (by view column) over those rows."""
    measures = measures or {}
    home = {c: f for f, cols in FACTORS.items() for c in cols}

    def held(name: str, value: Measure) -> Column:
        """The measure over a factor row's own entries."""
        def add(total, e):
            return (total + F.coalesce(value(e[name]), F.lit(0)) * e["n"]).cast("decimal(38,0)")
        return F.aggregate(home[name], F.lit(0).cast("decimal(38,0)"), add)

    sums = [F.sum(held(name, value)).cast("decimal(38,0)").alias(f"s_{name}") for name, value in measures.items()]
    sized = factors.groupBy("member_id").agg(*_sizes(), *sums)
    return sized.select("member_id", *[f"n_{f}" for f in FACTORS], _others(None).alias("n_rows"), *[
        (F.col(f"s_{name}") * _others(home[name])).cast("decimal(38,0)").alias(name) for name in measures])


def totals(factors: DataFrame, measures: dict[str, Measure] | None = None) -> DataFrame:
    """One row: ``n_rows`` of the whole view and each measure's sum over it."""
    per = member_totals(factors, measures)
    return per.agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ["n_rows", *(measures or {})]])


def expand(factors: DataFrame) -> DataFrame:
    """The view's rows of the given factor rows (filter by member first for a
    few): a chain of equi-joins of the entries by member, as in the view."""
    def entries(f: str) -> DataFrame:
        each = factors.select("member_id", F.explode(f).alias(f))
        return each.select("member_id", f, F.explode(F.sequence(F.lit(1), F.col(f"{f}.n"))).alias("__i")).drop("__i")

    out = entries("customers")
    for f in ("loans", "delinq", "details"):
        other = entries(f).select(F.col("member_id").alias("__m"), f)
        out = out.join(other, F.col("member_id") == F.col("__m"), "left").drop("__m")
    return out.select("member_id", *[F.col(f"{f}.{c}").alias(c) for f, cols in FACTORS.items() for c in cols]) \
        .select(*VIEW_COLUMNS)
