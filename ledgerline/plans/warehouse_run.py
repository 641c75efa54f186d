"""Whole daily run: staging -> core -> marts, on Parquet tables, committed as one.

Plain Parquet tables take no ``UPDATE``/``DELETE``, so every write is a new directory, and the run's
manifest (``sinks.run_state``), written last, makes all of them current together: rows, files taken,
marks and log. A run that stops half way changes nothing and is simply started again. Marks for
every table are read before anything is written.

The fact and the staged transactions grow without bound, so they are not copied per run: they are
partitioned by month, and a run writes only the months it changed; a month that a run empties is
absent from the manifest. Their marks are kept with the state, so no run scans them for a maximum.

The marts do not read the fact again: the rows of the changed months as they were (counted out) and
as they are (counted in) give the change of every account's and every day's total, which are kept
as tables of their own (``operators.marts``). Row counts come from the writes themselves.

Order of work (the reference's task chain): all staging tables, then the
transaction files, then core inserts (customer, branch, account, fact) and
updates, then both marts. Each table is one Spark job; AQE sizes the shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import DEFAULT_MARK, FORMAT_SNAPSHOT, ntz
from ledgerline.operators import dimensions as dims
from ledgerline.operators import incremental as inc
from ledgerline.operators import marts, merge
from ledgerline.operators.facts import fact_rejects, fact_transaction, orphan_accounts
from ledgerline.operators.joins import small
from ledgerline.schemas import STAGING_TABLES
from ledgerline.session import work_path
from ledgerline.sinks import writers
from ledgerline.sinks.run_state import Run, State
from ledgerline.sources import files, xlsx

FILES_TAKEN = "file_path string, modified timestamp, length long"
# Files of a run are listed to the driver and loaded so many at a time.
FILES_AT_ONCE = 1000
FACT, STAGED = "core/FactTransaction", "staging/transaction_raw"


# Staging tables stored month-partitioned (by month of ``dtmcrt``).
MONTH_PARTITIONED_STAGING = ("transaction",)


def created_month(c: str = "dtmcrt") -> Column:
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _upsert_partitioned(run: Run, shape, src: DataFrame, spec, mark: str, batch_ts: str,
                        appended: DataFrame | None = None) -> str:
    """Staging upsert that rewrites only the months it changes: months of staged rows the
    purge removes, of newly extracted rows and of ``appended`` rows (from files). The purge
    test needs one scan of the staged key/load/create columns. Returns the new mark."""
    name, cols = f"staging/{spec.raw_name}", list(spec.columns) + ["dtmload"]
    extract = inc.incremental_extract(src, spec, mark, batch_ts).select(*cols)
    if appended is not None:
        extract = extract.unionByName(appended.select(*cols))
    staged = run.read_parts(name, shape)
    purged = inc.staging_purged(staged.select(spec.key, "dtmload", "dtmcrt"), src, spec.key)
    touched = (extract.select(created_month().alias("m"))
               .unionByName(purged.select(created_month().alias("m"))).distinct())
    # bounded by calendar months: a small driver-side list
    months = [r["m"] for r in touched.collect()]
    kept = inc.staging_purge(run.read_parts(name, shape, months), src, spec.key).select(*cols)
    latest = run.write_parts(name, kept.unionByName(extract), created_month(), months, latest="dtmload")
    return _later(mark, latest)


def _later(mark: str, latest) -> str:
    """The later of a mark and a time stamp, cut to seconds as marks are."""
    return mark if latest is None else max(mark, latest.strftime("%Y-%m-%d %H:%M:%S"))


def fact_month(c: str = "TransactionDateID") -> Column:
    return (F.col(c) / 100).cast("int")


def read_fact(spark: SparkSession, base: str, shape: DataFrame) -> DataFrame:
    """The current ``FactTransaction`` of a warehouse under ``base``."""
    return State(spark, base).read_parts(FACT, shape.schema)


def read_fact_by_month(spark: SparkSession, base: str, shape: DataFrame) -> DataFrame:
    """The same with its month (``yyyyMM``) as the partition column ``__part``."""
    return State(spark, base).read_by_part(FACT, shape.schema)


STAGED_TRANSACTIONS = ("transaction_id long, account_id long, transaction_date timestamp_ntz, amount double, "
                       "transaction_type string, branch_id long, dtmcrt timestamp_ntz, dtmload timestamp_ntz")


def read_staged_transactions(spark: SparkSession, base: str) -> DataFrame:
    """The current ``transaction_raw`` of a warehouse under ``base``."""
    return State(spark, base).read_parts(STAGED, STAGED_TRANSACTIONS)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A current whole table, such as ``mart/CustomerMart``."""
    path = State(spark, base).path(name)
    if path is None:
        raise ValueError(f"no run has written {name}")
    return spark.read.parquet(path)


def _stamp(spark: SparkSession, batch_ts: str) -> str:
    return spark.range(1).select(
        F.date_format(F.lit(batch_ts).cast("timestamp_ntz"), FORMAT_SNAPSHOT)).first()[0]


def _concurrently(tasks: dict, workers: int = 4) -> dict:
    """Run independent steps from a small thread pool so Spark schedules
    their jobs side by side (small tables do not leave executors idle while
    a large one runs). Results keep the order of ``tasks``."""
    if len(tasks) <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as ex:
        futures = {k: ex.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def _take_files(run: Run, folder: str, batch_ts: str) -> DataFrame | None:
    """Rows of the files under ``folder`` that no earlier run took (None without such files).
    Writes the list of files taken (path, time, length) and both reject sets."""
    spark, key = run.spark, ["file_path", "modified", "length"]
    taken = run.read("staging/files_taken", FILES_TAKEN)
    listed = files.list_files(spark, [folder], "*.csv").unionByName(files.list_files(spark, [folder], "*.xlsx"))
    listing = work_path(spark, "new-files")
    listed.join(taken, key, "left_anti").write.parquet(listing)
    new = spark.read.parquet(listing)
    n = new.count()
    if not n:
        return None
    # some at a time, so that neither the list of paths nor a plan grows with an old folder
    chunks = -(-n // FILES_AT_ONCE)
    typed_rows, rejected_files = [], []
    for chunk in range(chunks):
        mine = new.where(F.pmod(F.xxhash64("file_path"), F.lit(chunks)) == chunk)
        paths = [r["path"] for r in mine.select("path").collect()]
        for end, ingest in ((".csv", files.ingest_csv), (".xlsx", xlsx.ingest_xlsx)):
            own = [files.literal_path(p) for p in paths if p.endswith(end)]
            if not own:
                continue
            typed_rows.append(work_path(spark, "typed-rows"))
            _, _, rejected = ingest(spark, own, batch_ts, typed_path=typed_rows[-1])
            rejected_files.append(work_path(spark, "file-files"))
            rejected.write.parquet(rejected_files[-1])
    # the rows lie typed already: they are not stored a second time
    good, bad = files.split_typed(spark.read.parquet(*typed_rows), batch_ts)
    run.write("rejects/file_rows", bad.withColumnRenamed("__date_text", "date_text"), "rejects_file_rows")
    run.write("rejects/files", spark.read.parquet(*rejected_files), "rejects_files")
    run.write("staging/files_taken", taken.unionByName(new.select(*key)))
    return good.drop("file_path")


def changed_fact_rows(run: Run, schema, months: list | None) -> DataFrame:
    """The signed change of the fact in a run that wrote ``months`` (None: all): their rows before it
    count out (``__sign`` -1), their rows after it count in. Nothing else of the fact is read."""
    cols = ("AccountID", "TransactionDateID", "TransactionType", "Amount")
    sides = [state.read_parts(FACT, schema, months).select(*cols, F.lit(sign).alias("__sign"))
             for state, sign in ((run, -1), (run.now, 1))]
    return sides[0].unionByName(sides[1])


def run_all(spark: SparkSession, sources: dict[str, DataFrame], base: str, batch_ts: str,
            files_dir: str | None = None, on_write: Callable[[str], None] | None = None) -> dict[str, str]:
    """One daily run over ``sources`` (the six source tables with ``dtmcrt``/``dtmupd``) and,
    if given, the transaction files (CSV, Excel) under ``files_dir`` that no earlier run took;
    they are appended after the table's own rows. Returns the path of every table written.
    ``on_write(name)`` is called after every write; if it raises, the run stops uncommitted.

    Dependencies: staging tables are independent of each other; the date
    dimension needs staging; customer, branch and account need the date
    dimension; the fact needs account and branch; marts and reject sets
    need the fact. Steps without a dependency between them run together.
    """
    run = Run(spark, base, _stamp(spark, batch_ts), on_write)

    # staging: marks first, then one upsert per table
    shapes = {s.name: sources[s.name].select(*s.columns).withColumn("dtmload", ntz(batch_ts)).schema for s in STAGING_TABLES}
    by_month = MONTH_PARTITIONED_STAGING
    staged_now = {s.name: run.read(f"staging/{s.raw_name}", shapes[s.name]) for s in STAGING_TABLES if s.name not in by_month}
    marks = _concurrently({n: (lambda n=n: inc.read_mark(staged_now[n])) for n in staged_now})
    marks.update({n: run.mark(n, DEFAULT_MARK) for n in by_month})
    file_rows = _take_files(run, files_dir, batch_ts) if files_dir else None

    def upsert(s):
        if s.name in by_month:
            run.set_mark(s.name, _upsert_partitioned(run, shapes[s.name], sources[s.name], s, marks[s.name], batch_ts, file_rows))
        else:
            run.write(f"staging/{s.raw_name}", inc.staging_upsert(staged_now[s.name], sources[s.name], s, marks[s.name], batch_ts))

    _concurrently({s.raw_name: (lambda s=s: upsert(s)) for s in STAGING_TABLES})
    raw = {s.name: (run.now.read_parts if s.name in by_month else run.now.read)(f"staging/{s.raw_name}", shapes[s.name])
           for s in STAGING_TABLES}

    # core: date dimension, marks, inserts, then updates
    dd_new = dims.dim_date_covering((raw["account"], "date_opened"), (raw["transaction"], "transaction_date"))
    dd_old = run.read("core/DimDate", dd_new.schema)
    run.write("core/DimDate", dd_old.unionByName(dd_new.join(dd_old.select("DateID"), "DateID", "left_anti")))
    dim_date = run.now.read("core/DimDate", dd_new.schema)

    new = {
        "DimCustomer": dims.dim_customer(raw["customer"], raw["city"], raw["state"], batch_ts),
        "DimBranch": dims.dim_branch(raw["branch"], batch_ts),
        "DimAccount": dims.dim_account(raw["account"], dim_date, batch_ts),
    }
    old = {n: run.read(f"core/{n}", df.schema) for n, df in new.items()}
    fact_schema = fact_transaction(raw["transaction"], new["DimAccount"], new["DimBranch"], dim_date, batch_ts).schema
    core_marks = _concurrently({n: (lambda n=n: inc.read_mark(old[n])) for n in new})
    core_marks["FactTransaction"] = run.mark("FactTransaction", DEFAULT_MARK)

    def load_customer():
        cust = old["DimCustomer"].unionByName(dims.dim_customer(
            raw["customer"], raw["city"], raw["state"], batch_ts, target=old["DimCustomer"]))
        return run.write("core/DimCustomer", merge.update_dim_customer(
            cust, raw["customer"], raw["city"], raw["state"], batch_ts, core_marks["DimCustomer"]))

    def load_branch():
        br = old["DimBranch"].unionByName(dims.dim_branch(raw["branch"], batch_ts, target=old["DimBranch"]))
        return run.write("core/DimBranch", merge.update_dim_branch(br, raw["branch"], batch_ts, core_marks["DimBranch"]))

    def load_account():
        acct = old["DimAccount"].unionByName(dims.dim_account(raw["account"], dim_date, batch_ts, target=old["DimAccount"]))
        return run.write("core/DimAccount", merge.update_dim_account(acct, raw["account"], batch_ts, core_marks["DimAccount"]))

    _concurrently({"DimCustomer": load_customer, "DimBranch": load_branch, "DimAccount": load_account})
    dim = {n: run.now.read(f"core/{n}", df.schema) for n, df in new.items()}

    keys = run.read_parts(FACT, fact_schema).select("TransactionID", "TransactionDateID")
    # the accounts that transactions have and the core lacks are found once, for the load and the rejects
    orphan_path = work_path(spark, "orphan-accounts")
    orphan_accounts(raw["transaction"], dim["DimAccount"]).write.parquet(orphan_path)
    orphans = spark.read.parquet(orphan_path)
    orphans = small(orphans, orphans.count())
    inserted = fact_transaction(raw["transaction"], dim["DimAccount"], dim["DimBranch"], dim_date, batch_ts, target=keys,
                                orphans=orphans)
    if run.parts(FACT):
        # the new rows are ranked once: they give the list of months and the rows to write
        new_path = work_path(spark, "new-facts")
        inserted.write.parquet(new_path)
        inserted = spark.read.schema(fact_schema).parquet(new_path)
        # whichever copy of a key counts, its key is the same: nothing is ranked for the list of months
        changed = merge.staged_after(raw["transaction"], "transaction_id",
                                     core_marks["FactTransaction"]).select(F.col("transaction_id").alias("TransactionID"))
        touched = (inserted.select(fact_month().alias("m"))
                   .unionByName(keys.join(changed, "TransactionID", "left_semi").select(fact_month().alias("m")))
                   .distinct())
        # bounded by calendar months in the data: a small driver-side list
        months = [r["m"] for r in touched.collect()]
    else:
        # no month to replace: the new rows are ranked, updated and written in one job, where they
        # meet the changes as they are dealt out by their key already
        months = None
    fact = merge.update_fact_transaction(run.read_parts(FACT, fact_schema, months).unionByName(inserted), raw["transaction"],
                                         batch_ts, core_marks["FactTransaction"])
    latest = run.write_parts(FACT, fact, fact_month(), months or [], latest="dtmload")
    run.set_mark("FactTransaction", _later(core_marks["FactTransaction"], latest))

    # marts from the changes of the fact, and reject sets of this run
    change = changed_fact_rows(run, fact_schema, months)

    def load_customer_mart():
        nets = run.read("mart/account_net", marts.ACCOUNT_NET)
        run.write("mart/account_net", marts.add_account_changes(nets, change))
        return run.write("mart/CustomerMart", marts.customer_balances(
            dim["DimCustomer"], dim["DimAccount"], run.now.read("mart/account_net", marts.ACCOUNT_NET)))

    def load_daily_mart():
        days = run.read("mart/day_total", marts.DAY_TOTAL)
        run.write("mart/day_total", marts.add_day_changes(days, change))
        return run.write("mart/DailySummaryMart", marts.daily_totals(
            run.now.read("mart/day_total", marts.DAY_TOTAL), dim_date))

    _concurrently({
        "CustomerMart": load_customer_mart,
        "DailySummaryMart": load_daily_mart,
        "rejects_customer": lambda: run.write(
            "rejects/customer", dims.customer_rejects(raw["customer"], raw["city"], raw["state"]), "rejects_customer"),
        "rejects_transaction": lambda: run.write(
            "rejects/transaction", fact_rejects(raw["transaction"], dim["DimAccount"], dim["DimBranch"], dim_date, orphans),
            "rejects_transaction"),
    })
    _log_run(run, batch_ts)
    run.commit()
    return {n: run.written[n] for n in _logged(run)}


# Order of the log: the tables of the chain; what keeps the marts up to date is not a stage.
STAGES = (*[s.raw_name for s in STAGING_TABLES], "rejects_file_rows", "rejects_files", "files_taken", "DimDate",
          "DimCustomer", "DimBranch", "DimAccount", "FactTransaction", "CustomerMart", "DailySummaryMart",
          "rejects_customer", "rejects_transaction")


def _logged(run: Run) -> list[str]:
    return [n for n in STAGES if n in run.written]


def _log_run(run: Run, batch_ts: str) -> None:
    """One record per table written, ``run_log(run_id, seq, stage, ts, message, rows)``, with the
    rows that its write counted; a batch that is run again replaces its own records."""
    rows = [(run.stamp, seq, n, f"{n} written", run.counts[n]) for seq, n in enumerate(_logged(run), start=1)]
    log = run.spark.createDataFrame(rows, "run_id string, seq int, stage string, message string, rows long").coalesce(1)
    run.add_part("run_log", run.stamp, log.select("run_id", "seq", "stage", ntz(batch_ts).alias("ts"), "message", "rows"))


def read_run_log(spark: SparkSession, base: str) -> DataFrame:
    return State(spark, base).read_parts("run_log", writers.RUN_LOG_SCHEMA)
