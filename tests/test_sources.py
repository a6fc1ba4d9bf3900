"""Source and catalog behaviours the workload relies on."""

from lendscope.session import shared_path
from lendscope.sources import catalog
from lendscope.sources.files import read_csv_schema, read_csv_strings, write_csv, write_parquet


def test_fixed_ddl_binds_by_position_and_nulls_bad_cells(spark):
    df = spark.createDataFrame([("1", "12.5"), ("2", "abc"), ("3", "")], "a string, b string")
    path = write_csv(df, shared_path(spark, "tests", "bad_cells_csv"))
    back = read_csv_schema(spark, path, "loan_id string, amount float")
    assert back.columns == ["loan_id", "amount"]  # header names ignored: positional
    got = {r.loan_id: r.amount for r in back.collect()}
    assert got == {"1": 12.5, "2": None, "3": None}
    assert [f.dataType.simpleString() for f in read_csv_strings(spark, path).schema] == ["string", "string"]


def test_declared_column_missing_from_files_reads_null(spark):
    df = spark.createDataFrame([("m1", 1.0)], "member_id string, tot_hi_cred_lim float")
    path = write_parquet(df, shared_path(spark, "tests", "missing_col_parquet"))
    catalog.create_database(spark, "lendscope_src_test", shared_path(spark, "tests", "warehouse_src"))
    name = catalog.create_external_table(
        spark, "lendscope_src_test", "c", "member_id string, total_high_credit_limit float", path)
    r = catalog.scan_table(spark, name).first()
    assert r.member_id == "m1" and r.total_high_credit_limit is None


def test_wide_csv_with_schema_skips_inference(spark, sf_small):
    from lendscope.plans.registry import frames
    from lendscope.sources.files import read_wide_loans
    raw = frames(spark, sf_small).raw
    path = write_csv(raw, shared_path(spark, "tests", "wide_csv_schema"))
    inferred = read_wide_loans(spark, path)
    given = read_wide_loans(spark, path, schema=inferred.schema)
    assert given.schema == inferred.schema
    assert given.exceptAll(inferred).count() == 0 and given.count() == raw.count()


def test_direct_split_equals_the_csv_hop(spark):
    """Trimmed strings, blanks as NULL, malformed numbers as NULL, as after a CSV write and read."""
    from pyspark.sql import functions as F
    from lendscope import schemas
    from lendscope.operators import split
    cells = ["OWN ", " A", "\tx ", "", "   ", None, "n/a", " 12.5 ", "1e3", "plain", "-7", "x\ty"]
    names = ["name_sha2", "emp_title", "emp_length", "home_ownership", "annual_inc", "addr_state", "zip_code", "grade",
             "sub_grade", "verification_status", "tot_hi_cred_lim", "application_type", "annual_inc_joint",
             "verification_status_joint"]
    rows = [tuple([f"id{i}"] + [cells[(i + j) % len(cells)] for j in range(len(names) - 1)]) for i in range(len(cells))]
    keyed = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    order = ["name_sha2", "emp_title", "emp_length", "home_ownership", "annual_inc", "addr_state", "zip_code", "country",
             *names[7:]]
    path = write_csv(keyed.withColumn("country", F.lit("USA")).select(*order), shared_path(spark, "tests", "hop_csv"))
    hop = read_csv_schema(spark, path, schemas.CUSTOMERS_RAW_DDL)
    direct = split.split_customers(keyed)
    assert sorted(map(tuple, direct.collect()), key=str) == sorted(map(tuple, hop.collect()), key=str)


def test_line_breaks_can_be_replaced_on_write(spark):
    df = spark.createDataFrame([("a", "x\ny"), ("b", "p\r\nq")], "k string, v string")
    path = write_csv(df, shared_path(spark, "tests", "breaks_csv"), line_breaks=" ")
    assert sorted(map(tuple, read_csv_strings(spark, path).collect())) == [("a", "x y"), ("b", "p q")]


def test_a_quote_in_a_location(spark):
    path = shared_path(spark, "tests", "it's here")
    write_parquet(spark.createDataFrame([("m",)], "member_id string"), path + "/t")
    catalog.create_database(spark, "lendscope_quote_test", path + "/db")
    name = catalog.create_external_table(spark, "lendscope_quote_test", "t", "member_id string", path + "/t")
    assert catalog.scan_table(spark, name).count() == 1
