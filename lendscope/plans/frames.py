"""The workload's frames, derived lazily from a data directory.

``LendingFrames`` names every intermediate table of the flow (wide rows ->
splits -> cleaned tables -> quarantine -> score) as a lazily built
DataFrame. Nothing runs until an action, apart from the one-time writes of
the keyed wide table and the cleaned customers (see ``LendingFrames``); each registered
query is one of these frames or a small projection of one, so Catalyst sees
the whole chain and prunes columns down to the scans.
"""

from __future__ import annotations

import threading
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendscope.operators import clean, quarantine, score, split
from lendscope.operators.consolidate import consolidated_view
from lendscope.rules import DEFAULT_RULES, ScoreRules
from lendscope.session import input_fingerprint, scratch_path
from lendscope.sources import catalog
from lendscope.sources.tables import STAR_TABLES, star_tables
from lendscope.sources.testbed import keyed_loans, raw_loans

# Deterministic ingestion stamp for checked queries (current_timestamp() would
# differ between runs and engines).
FIXED_INGEST_TS = "2024-01-01 00:00:00"

#: Bytes of input tables a bucket of the written frames stands for, about.
BUCKET_INPUT_BYTES = 32 << 20


class LendingFrames:
    """Named frames of the flow over one data directory, owned by its caller.

    With ``materialize_wide`` (the default) the keyed wide table and the cleaned
    customers are each written once, as Parquet under the shared checkpoint
    folder, and later frames scan them. That cuts the lineage back to the
    star-schema join (which would otherwise be re-derived in every branch of a
    plan) and lets each branch read only its own columns. Both are tables bucketed
    by the member key, which most later steps group and join by: those read the
    buckets in place instead of shuffling 64 characters of key a row and table. The
    wide rows are dealt by the key before they get wide. A frame that has a single branch gains nothing from
    it: ``narrow`` derives such frames straight from the inputs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, ingest_ts=FIXED_INGEST_TS,
                 rules: ScoreRules = DEFAULT_RULES, materialize_wide: bool = True,
                 repartition: int | None = None, dedup: bool = False, delinq_join: str = "inner"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.ingest_ts = ingest_ts
        self.rules = rules
        self.materialize_wide = materialize_wide
        self.repartition = repartition
        self.dedup = dedup
        self.delinq_join = delinq_join
        self._write_lock = threading.RLock()
        self._written: dict[str, DataFrame] = {}
        self._given: set[str] = set()
        self._db: str | None = None

    @cached_property
    def _lazy(self) -> "LendingFrames":
        return LendingFrames(self.spark, self.sf_dir, self.ingest_ts, self.rules, materialize_wide=False,
                             repartition=self.repartition, dedup=self.dedup, delinq_join=self.delinq_join)

    @property
    def narrow(self) -> "LendingFrames":
        """Frames for a query that reads the wide rows once: from the written wide
        table if there is one, else straight from the inputs."""
        return self if "keyed" in self._written or not self.materialize_wide else self._lazy

    @cached_property
    def buckets(self) -> int:
        """Buckets of the written frames: as many as the session's shuffles have
        partitions, more where the inputs are large."""
        files = input_fingerprint(self.spark, [f"{self.sf_dir.rstrip('/')}/{t}.parquet" for t in STAR_TABLES])
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")),
                   sum(length for _, length, _ in files or ()) // BUCKET_INPUT_BYTES)

    def _once(self, name: str, df: DataFrame, key: str, dealt: bool) -> DataFrame:
        """``df`` written on first use as a table of its own, bucketed by ``key``, and
        read back; ``dealt``: its rows lie by the buckets already."""
        if not self.materialize_wide:
            return df
        with self._write_lock:  # one writer even if queries are built from several threads
            if name not in self._written:
                if self._db is None:
                    self._db = f"lendscope_frames_{uuid.uuid4().hex[:12]}"
                    catalog.create_database(self.spark, self._db, scratch_path(self.spark, "frames", "db"))
                table = catalog.save_bucketed_table(df, self._db, name, scratch_path(self.spark, "frames", name), key,
                                                    self.buckets, dealt)
                self._written[name] = catalog.scan_table(self.spark, table)
            return self._written[name]

    def use(self, **frames: DataFrame) -> "LendingFrames":
        """Replace named frames (e.g. with tables read back from storage);
        every frame derived later builds on the replacement."""
        for name, df in frames.items():
            if not isinstance(getattr(type(self), name, None), cached_property):
                raise AttributeError(f"unknown frame {name!r}")
            self.__dict__[name] = df
            self._given.add(name)
        return self

    def use_keyed(self, keyed: DataFrame) -> "LendingFrames":
        """Take other keyed rows that lie by the key already (from a written keyed table,
        or dealt over ``buckets`` partitions by ``name_sha2``) and write them as this
        graph's own."""
        self.__dict__["keyed"] = self._once("keyed", keyed, "name_sha2", dealt=True)
        return self

    # wide table and splits
    @cached_property
    def raw(self) -> DataFrame:
        return raw_loans(star_tables(self.spark, self.sf_dir), self.repartition)

    @cached_property
    def keyed(self) -> DataFrame:
        dealt = self.materialize_wide and "raw" not in self._given
        raw = raw_loans(star_tables(self.spark, self.sf_dir), self.repartition, self.buckets) if dealt else self.raw
        return self._once("keyed", keyed_loans(raw), "name_sha2", dealt)

    @cached_property
    def customers_raw(self) -> DataFrame:
        return split.split_customers(self.keyed)

    @cached_property
    def loans_raw(self) -> DataFrame:
        return split.split_loans(self.keyed)

    @cached_property
    def repayments_raw(self) -> DataFrame:
        return split.split_repayments(self.keyed)

    @cached_property
    def defaulters_raw(self) -> DataFrame:
        return split.split_defaulters(self.keyed)

    # cleaned tables
    @cached_property
    def customers_renamed(self) -> DataFrame:
        df = clean.strict_rename(self.customers_raw, clean.CUSTOMER_RENAMES)
        return clean.dedup_rows(clean.ingest_stamp(df, self.ingest_ts))

    @cached_property
    def customers_income(self) -> DataFrame:
        return clean.filter_not_null(self.customers_renamed, "annual_income")

    @cached_property
    def customers(self) -> DataFrame:
        # rows read from the keyed table's buckets are de-duplicated there, and stay there
        cleaned = clean.clean_customers(self.customers_raw, self.ingest_ts)
        dealt = "keyed" in self._written and not self._given & {"keyed", "customers_raw"}
        return self._once("customers", cleaned, "member_id", dealt)

    @cached_property
    def loans(self) -> DataFrame:
        return clean.clean_loans(self.loans_raw, self.ingest_ts, self.dedup)

    @cached_property
    def repayments(self) -> DataFrame:
        return clean.clean_repayments(self.repayments_raw, self.ingest_ts, self.dedup)

    @cached_property
    def defaulters(self) -> DataFrame:
        return clean.stamped_defaulters(self.defaulters_raw, self.ingest_ts, self.dedup)

    @cached_property
    def delinq(self) -> DataFrame:
        return clean.delinquent_members(self.defaulters)

    @cached_property
    def records_enq(self) -> DataFrame:
        return clean.record_enquiry_members(self.defaulters)

    @cached_property
    def details(self) -> DataFrame:
        return clean.defaulter_details(self.defaulters)

    # published-table views (declared columns only)
    @cached_property
    def delinq_table(self) -> DataFrame:
        return self.delinq.select("member_id", "delinq_2yrs", "delinq_amnt", "mths_since_last_delinq")

    @cached_property
    def details_table(self) -> DataFrame:
        return self.details.select("member_id", "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")

    # quarantine
    @cached_property
    def dup_customers(self) -> DataFrame:
        return quarantine.duplicate_keys(self.customers)

    @cached_property
    def dup_delinq(self) -> DataFrame:
        return quarantine.duplicate_keys(self.delinq_table)

    @cached_property
    def dup_details(self) -> DataFrame:
        return quarantine.duplicate_keys(self.details_table)

    @cached_property
    def dup_ids(self) -> DataFrame:
        return quarantine.quarantined_ids(self.quarantine_sources)

    @property
    def quarantine_sources(self) -> dict[str, DataFrame]:
        """The tables whose duplicated member ids are quarantined."""
        return {"customers": self.customers, "loans_defaulters_delinq": self.delinq_table,
                "loans_defaulters_details": self.details_table}

    @cached_property
    def customers_c(self) -> DataFrame:
        return quarantine.drop_quarantined(self.customers, self.dup_ids)

    @cached_property
    def delinq_c(self) -> DataFrame:
        return quarantine.drop_quarantined(self.delinq_table, self.dup_ids)

    @cached_property
    def details_c(self) -> DataFrame:
        return quarantine.drop_quarantined(self.details_table, self.dup_ids)

    # consolidated view
    @cached_property
    def consolidated(self) -> DataFrame:
        return consolidated_view(self.customers, self.loans, self.repayments,
                                 self.delinq_table, self.details_table, partitioned=self.materialize_wide)

    # score
    @cached_property
    def loans_q(self) -> DataFrame:
        return quarantine.drop_quarantined(self.loans, self.dup_ids)

    @cached_property
    def _carried_history(self) -> DataFrame:
        """Payment history with the loan columns that later points need."""
        return score.payment_history(self.repayments, self.loans_q, None, self.rules, score.LOAN_CARRY)

    @cached_property
    def payment_history(self) -> DataFrame:
        return score.payment_history(self.repayments, self.loans_q, None, self.rules)

    @cached_property
    def defaulter_history(self) -> DataFrame:
        return score.defaulter_history(self.payment_history, self.details_table, self.delinq_table, self.rules,
                                       self.delinq_join)

    @cached_property
    def financial_health(self) -> DataFrame:
        carried = score.defaulter_history(self._carried_history, self.details_table, self.delinq_table, self.rules,
                                          self.delinq_join)
        return score.financial_health(carried, None, self.customers, None, self.rules)

    @cached_property
    def weighted(self) -> DataFrame:
        return score.weighted_score(self.financial_health, self.rules)

    @cached_property
    def score(self) -> DataFrame:
        return score.graded(self.weighted, self.rules)


class FrameStore:
    """Frame graphs of one owner, by session and data directory.

    A graph is kept only while the names, lengths and modification times of its
    input files stay the same; after any change, or where files can't be listed,
    the next query gets a new one. One graph is held per directory.
    ``repartition`` is handed on to the graphs (default: none)."""

    def __init__(self, repartition: int | None = None):
        self.repartition = repartition
        self._held: dict[str, tuple[object, SparkSession, LendingFrames]] = {}
        self._lock = threading.Lock()

    def frames(self, spark: SparkSession, sf_dir: str) -> LendingFrames:
        now = input_fingerprint(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in STAR_TABLES])
        with self._lock:
            held = self._held.get(sf_dir)
            if now is None or held is None or held[0] != now or held[1] is not spark:
                held = self._held[sf_dir] = (now, spark, LendingFrames(
                    spark, sf_dir, repartition=self.repartition))
            return held[2]
