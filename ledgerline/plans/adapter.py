"""Test tables -> the warehouse's source, staging and core inputs.

The driver's tables (TPC-H-like) stand in for the bank's source database:

================  ==========  =============================================
source table      from        columns
================  ==========  =============================================
customer          customer    c_custkey, c_name, address=c_mktsegment,
                              city_id=c_nationkey, age, gender, email
city              nation      n_nationkey, n_name, state_id=n_regionkey
state             region      r_regionkey, r_name
branch            supplier    s_suppkey, s_name, location = nation name
account           orders      o_orderkey, o_custkey, type=o_orderstatus,
                              balance=o_totalprice, opened=o_orderdate,
                              status=o_orderpriority
transaction       lineitem    id=l_orderkey*10+l_linenumber (ids repeat),
                              account=l_orderkey, date=l_shipdate,
                              amount=l_extendedprice, type from
                              l_returnflag, branch=l_suppkey
================  ==========  =============================================

Audit columns are deterministic functions of keys and dates (the same rule
is written in SQL for the oracle): ``dtmcrt`` is the row's own date or a
day offset of the key; every fifth key was updated ``key % 900 + 1`` days
after creation. The staging layer seen by the core stage stamped each row
the day after its last change. The scenario constants below are fixed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import ntz

# Fixed values of the test scenario.
EPOCH = "1995-01-01 00:00:00"            # creation day of key 0
PREV_RUN_END = "2000-01-01 00:00:00"     # staging holds rows created before
BATCH_TS = "2002-01-01 00:00:00"         # time of the run under test
CORE_LOADED_AT = "2000-01-01 00:00:00"   # dtmload of rows already in core
UPDATE_EVERY = 5                         # key % 5 = 0 -> row was updated
EXISTING_EVERY = 3                       # key % 3 = 0 -> already in core
ORPHAN_BRANCH = (10, 3)                  # suppkey % 10 = 3 -> branch missing
ORPHAN_CITY = (5, 3)                     # nationkey % 5 = 3 -> city missing
FILE_ID_OFFSET = 1_000_000_000_000       # added to the ids of transactions in files
MOVED_MONTH = (1995, 3)                  # created then -> re-dated by the second run
MOVED_BY_MONTHS = 2
MOVED_AT = "2001-06-01 00:00:00"
TYPE_BY_FLAG = (("A", "Deposit"), ("N", "Withdrawal"), ("R", "Payment"))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days_after(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days, ts)


def _key_day(key: Column) -> Column:
    return _days_after(ntz(EPOCH), (key % 2400).cast("int"))


def _updated(key: Column, created: Column) -> Column:
    return F.when(key % UPDATE_EVERY == 0,
                  _days_after(created, (key % 900 + 1).cast("int")))


def _audit(df: DataFrame, key: str, created: Column) -> DataFrame:
    made = created.cast("timestamp_ntz")
    return df.select("*", made.alias("dtmcrt"), _updated(F.col(key), made).alias("dtmupd"))


class Tables(Mapping):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> "Tables":
        return Tables({n: (lambda n=n: change(self[n])) for n in self})


def _customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return _audit(c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("address"),
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Female")).otherwise(F.lit("Male"))
         .alias("gender"),
        F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@bank.test"))
         .alias("email"),
    ), "customer_id", _key_day(F.col("customer_id")))


def _city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(_read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("n_regionkey").cast("bigint").alias("state_id"),
    ), "city_id", _key_day(F.col("city_id")))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(_read(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("bigint").alias("state_id"),
        F.col("r_name").alias("state_name"),
    ), "state_id", _key_day(F.col("state_id")))


def _branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = _read(spark, sf_dir, "supplier"), _read(spark, sf_dir, "nation")
    # nation has 25 rows by construction of the data set: a bounded lookup
    nation_names = F.broadcast(n.select(F.col("n_nationkey").alias("__nk"),
                                        F.col("n_name").alias("branch_location")))
    return _audit(
        s.join(nation_names, F.col("s_nationkey") == F.col("__nk"), "left")
         .select(F.col("s_suppkey").alias("branch_id"),
                 F.col("s_name").alias("branch_name"),
                 F.col("branch_location")),
        "branch_id", _key_day(F.col("branch_id")))


def _account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(_read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("account_type"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderdate").alias("date_opened"),
        F.col("o_orderpriority").alias("status"),
    ), "account_id", F.col("date_opened"))


def _transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ttype = F.lit(None).cast("string")
    for flag, name in reversed(TYPE_BY_FLAG):
        ttype = F.when(F.col("l_returnflag") == flag, F.lit(name)).otherwise(ttype)
    return _audit(_read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_orderkey").alias("account_id"),
        F.col("l_shipdate").alias("transaction_date"),
        F.col("l_extendedprice").alias("amount"),
        ttype.alias("transaction_type"),
        F.col("l_suppkey").alias("branch_id"),
    ), "transaction_id", F.col("transaction_date"))


_SOURCES = {"customer": _customer, "city": _city, "state": _state, "branch": _branch, "account": _account,
            "transaction": _transaction}


def source_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The six source tables with ``dtmcrt`` and ``dtmupd``."""
    return Tables({n: (lambda make=make: make(spark, sf_dir)) for n, make in _SOURCES.items()})


def staged_load_time(df: DataFrame) -> Column:
    """Staging stamp of the core-stage scenario: the day after the last change."""
    return _days_after(F.date_trunc("DAY", F.coalesce(F.col("dtmupd"), F.col("dtmcrt"))),
                       F.lit(1)).cast("timestamp_ntz")


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Staging tables ``*_raw`` as the core stage reads them."""
    return source_tables(spark, sf_dir).map(lambda df: df.withColumn("dtmload", staged_load_time(df)).drop("dtmupd"))


def staged_before_run(sources: Tables) -> Tables:
    """Staging state before the run under test: rows created before
    ``PREV_RUN_END``, each staged by the monthly run after its creation."""
    return sources.map(lambda df: df.where(F.col("dtmcrt") < ntz(PREV_RUN_END)).withColumn(
        "dtmload", F.timestamp_add("MONTH", F.lit(1), F.date_trunc("MONTH", F.col("dtmcrt"))).cast("timestamp_ntz"))
        .drop("dtmupd"))


def branches_with_orphans(raw_branch: DataFrame) -> DataFrame:
    """Branch lookup with every tenth branch missing (makes orphans)."""
    m, r = ORPHAN_BRANCH
    return raw_branch.where(F.col("branch_id") % m != r)


def cities_with_orphans(raw_city: DataFrame) -> DataFrame:
    """City lookup with every fifth city missing (customers lose their city)."""
    m, r = ORPHAN_CITY
    return raw_city.where(F.col("city_id") % m != r)


def is_existing(key: Column) -> Column:
    return key % EXISTING_EVERY == 0


def two_runs(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """Source tables of two successive runs. The first sees the rows created before
    ``PREV_RUN_END``, none updated. The second sees all rows with their updates, and the
    transactions created in ``MOVED_MONTH`` re-dated by some months at ``MOVED_AT``."""
    second = dict(source_tables(spark, sf_dir))
    first = {n: df.where(F.col("dtmcrt") < ntz(PREV_RUN_END))
             .withColumn("dtmupd", F.lit(None).cast("timestamp_ntz")) for n, df in second.items()}
    year, month = MOVED_MONTH
    moved = (F.year("dtmcrt") == year) & (F.month("dtmcrt") == month)
    t = second["transaction"].withColumn("__moved", moved)
    second["transaction"] = (
        t.withColumn("dtmupd", F.when(F.col("__moved"), ntz(MOVED_AT)).otherwise(F.col("dtmupd")))
         .withColumn("dtmcrt", F.when(F.col("__moved"), F.timestamp_add("MONTH", F.lit(MOVED_BY_MONTHS), "dtmcrt")
                                      .cast("timestamp_ntz")).otherwise(F.col("dtmcrt"))).drop("__moved"))
    return first, second
