"""The warehouse scenario on the driver's test tables.

Builds lazy plans only; nothing is collected except high-water marks. The
functions here are what ``__spark_entry__.queries()`` registers.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import ntz
from ledgerline.operators import dimensions as dims
from ledgerline.operators import fx, marts, merge
from ledgerline.operators.facts import fact_transaction
from ledgerline.plans import adapter
from ledgerline.schemas import MONEY
from ledgerline.session import work_path
from ledgerline.sinks import xlsx as xlsx_sink


class Core:
    """Core tables of one load into an empty core, each built when it is first asked for."""

    def __init__(self, raw_tables: Mapping, batch_ts: str):
        self._raw, self._batch = raw_tables, batch_ts

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date_for(self._raw)

    @cached_property
    def dim_customer(self) -> DataFrame:
        r = self._raw
        return dims.dim_customer(r["customer"], r["city"], r["state"], self._batch)

    @cached_property
    def dim_branch(self) -> DataFrame:
        return dims.dim_branch(self._raw["branch"], self._batch)

    @cached_property
    def dim_account(self) -> DataFrame:
        return dims.dim_account(self._raw["account"], self.dim_date, self._batch)

    @cached_property
    def fact(self) -> DataFrame:
        return fact_transaction(self._raw["transaction"], self.dim_account, self.dim_branch, self.dim_date, self._batch)


def raw(spark: SparkSession, sf_dir: str) -> adapter.Tables:
    return adapter.raw_tables(spark, sf_dir)


def dim_date_for(raw_tables: Mapping) -> DataFrame:
    """Calendar covering every opening day and transaction day."""
    acct = raw_tables["account"]
    return dims.dim_date_covering((acct, "date_opened"), (raw_tables["transaction"], "transaction_date"))


def first_load(spark: SparkSession, sf_dir: str, batch_ts: str = adapter.BATCH_TS,
               raw_tables: Mapping | None = None) -> Core:
    """All core tables loaded into an empty core."""
    return Core(raw_tables or raw(spark, sf_dir), batch_ts)


# Columns replaced by placeholders in the rows that are already in core,
# so that an applied update is visible in the result.
def _stale() -> dict:
    return {
        "DimCustomer": {"Address": F.lit("UNKNOWN"), "Email": F.lit("UNKNOWN")},
        "DimBranch": {"BranchLocation": F.lit("UNKNOWN")},
        "DimAccount": {"Status": F.lit("UNKNOWN"), "Balance": F.lit(0).cast(MONEY)},
        "FactTransaction": {"TransactionType": F.lit("UNKNOWN"),
                            "Amount": F.lit(0).cast(MONEY)},
    }


def existing_core(spark: SparkSession, sf_dir: str, raw_tables: Mapping | None = None) -> adapter.Tables:
    """Core tables as a previous run left them: every third key, loaded at
    ``CORE_LOADED_AT``, with stale values in the updatable columns."""
    full, stale = first_load(spark, sf_dir, adapter.CORE_LOADED_AT, raw_tables), _stale()

    def left(name: str, table: str, key: str) -> DataFrame:
        df = getattr(full, table).where(adapter.is_existing(F.col(key)))
        return df.withColumns({**stale[name], "dtmload": ntz(adapter.CORE_LOADED_AT)})

    keys = {"DimCustomer": ("dim_customer", "CustomerID"), "DimBranch": ("dim_branch", "BranchID"),
            "DimAccount": ("dim_account", "AccountID"), "FactTransaction": ("fact", "TransactionID")}
    return adapter.Tables({**{n: (lambda n=n, t=t, k=k: left(n, t, k)) for n, (t, k) in keys.items()},
                           "DimDate": lambda: full.dim_date})


# The mark of every existing core table: they were all loaded at that time.
EXISTING_MARK = adapter.CORE_LOADED_AT


def core_run(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A core run over the existing core: for each table the new keys are loaded, then the
    type-1 merge of the staged changes after the table's mark runs over old and new rows."""
    r = raw(spark, sf_dir)
    old = existing_core(spark, sf_dir, r)
    b, mark = adapter.BATCH_TS, EXISTING_MARK
    cust = old["DimCustomer"].unionByName(
        dims.dim_customer(r["customer"], r["city"], r["state"], b, target=old["DimCustomer"]))
    branch = old["DimBranch"].unionByName(dims.dim_branch(r["branch"], b, target=old["DimBranch"]))
    account = old["DimAccount"].unionByName(dims.dim_account(r["account"], old["DimDate"], b, target=old["DimAccount"]))
    fact = old["FactTransaction"].unionByName(fact_transaction(
        r["transaction"], account, branch, old["DimDate"], b, target=old["FactTransaction"]))
    return {
        "DimCustomer": merge.update_dim_customer(cust, r["customer"], r["city"], r["state"], b, mark),
        "DimBranch": merge.update_dim_branch(branch, r["branch"], b, mark),
        "DimAccount": merge.update_dim_account(account, r["account"], b, mark),
        "FactTransaction": merge.update_fact_transaction(fact, r["transaction"], b, mark),
    }


def core_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted and rows updated by ``core_run``, counted in its result by their stamps:
    ``(table_name, action, n_rows)``."""
    batch, out = ntz(adapter.BATCH_TS), None
    for name, df in core_run(spark, sf_dir).items():
        c = df.agg(F.count(F.when(F.col("dtmload") == batch, 1)).alias("inserted"),
                   F.count(F.when(F.col("dtmupd") == batch, 1)).alias("updated"))
        c = c.unpivot([], ["inserted", "updated"], "action", "n_rows").select(
            F.lit(name).alias("table_name"), "action", "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def declared_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every table with declared constraints: core tables and marts of a first load, with every
    tenth branch missing from its table (so that references can fail)."""
    core = first_load(spark, sf_dir)
    m, rem = adapter.ORPHAN_BRANCH
    return {
        "DimDate": core.dim_date, "DimCustomer": core.dim_customer, "DimAccount": core.dim_account,
        "DimBranch": core.dim_branch.where(F.col("BranchID") % m != rem), "FactTransaction": core.fact,
        "DailySummaryMart": marts.daily_summary(core.fact, core.dim_date),
        "CustomerMart": marts.customer_mart(core.dim_customer, core.dim_account, core.fact),
    }


def fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reject counts of the fact load when every tenth branch is missing:
    ``(reject_reason, n_rows)`` for null keys and missing account, branch
    or day (first failing rule wins)."""
    from ledgerline.operators.facts import fact_rejects as tag_fact_rejects
    from ledgerline.operators.quality import reject_counts

    r = raw(spark, sf_dir)
    core = first_load(spark, sf_dir, raw_tables=r)
    m, rem = adapter.ORPHAN_BRANCH
    br = core.dim_branch.where(F.col("BranchID") % m != rem)   # every tenth branch missing
    return reject_counts(tag_fact_rejects(r["transaction"], core.dim_account, br,
                                          core.dim_date))


# --- derived inputs for the banks, files and scalar-function queries ---------

# Text formats the test transactions are written in, chosen by line number
# (transaction_id % 10) and account (account_id % 3); line 7 gets an impossible date. A format
# ending in an offset gets the wall-clock time of that zone.
DATE_TEXT_FORMATS = (
    (1, ("dd-MM-yyyy HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'+05:30'")),
    (2, ("yyyy-MM-dd", "yyyy-MMM-dd", "yyyy/MM/dd HH:mm:ss.SSS")),
    (3, ("dd/MM/yyyy", "EEE, dd MMM yyyy", "dd.MM.yyyy HH:mm")),
    (4, ("yyyyMMdd", "yyyyMMddHHmmss", "yyyyMMdd'T'HHmm")),
    (5, ("dd-MMM-yyyy", "MMMM d, yyyy", "dd-MMMM-yyyy hh:mm a")),
    (6, ("d/M/yy", "d MMM yyyy", "EEEE d MMMM yyyy")),
)
OFFSET_MINUTES = 330


def _date_text(fmt: str):
    ts = F.col("transaction_date")
    if fmt.endswith("'+05:30'"):
        ts = F.timestamp_add("MINUTE", F.lit(OFFSET_MINUTES), ts)
    return F.date_format(ts, fmt)


def transaction_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source transactions with ``date_text``: the transaction date as
    text in one of many forms (and some invalid)."""
    t = adapter.source_tables(spark, sf_dir)["transaction"]
    line, variant = F.col("transaction_id") % 10, F.col("account_id") % 3
    txt = F.concat(F.lit("31-02-"), F.date_format("transaction_date", "yyyy"))
    for n, formats in reversed(DATE_TEXT_FORMATS):
        of_line = F.when(variant == 0, _date_text(formats[0])).when(variant == 1, _date_text(formats[1])) \
            .otherwise(_date_text(formats[2]))
        txt = F.when(line == n, of_line).otherwise(txt)
    return t.withColumn("date_text", txt)


# Columns a file has besides the required ones: a wide file, and texts with quotes and commas.
EXTRA_COLUMNS = 40


def _file_columns(t: DataFrame) -> DataFrame:
    """The columns of a good file: reordered, extra ones before and after the required ones."""
    extra = [F.lit(f"x{i}").alias(f"extra_{i}") for i in range(EXTRA_COLUMNS)]
    return t.select("account_id", *extra, "transaction_id", F.lit('Dep "x", y').alias("note"),
                    F.col("date_text").alias("transaction_date"), "amount", "transaction_type", "branch_id")


def _rename_parts(spark: SparkSession, folder: str, end: str, name) -> None:
    """Give the part files of ``folder`` that end in ``end`` the names ``name(number)``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(st.getPath().toString() for st in fs.listStatus(hadoop(folder))
                   if st.getPath().getName().startswith("part-") and st.getPath().getName().endswith(end))
    for i, part in enumerate(parts):
        fs.rename(hadoop(part), hadoop(f"{folder}/{name(i)}"))


def _indexed_columns(t: DataFrame) -> DataFrame:
    """The columns of a file that a data frame was saved to with its index, and that has a gap:
    two header cells are blank, and both columns hold values."""
    return t.select(F.monotonically_increasing_id().alias(" "), "transaction_id", "account_id",
                    F.col("date_text").alias("transaction_date"), F.lit(999).alias("  "), "amount", "transaction_type",
                    "branch_id")


# Files of each kind that the test transactions are written to: good ones, from data frames, without a branch.
FILES_OF_KIND = {"good": 6, "frame": 4, "bad": 1}


def _dealt(t: DataFrame, path: str) -> dict[str, list[DataFrame]]:
    """The rows of ``t`` by kind and file. The rows of a file pass one task, so they are packed
    first, by all tasks: narrow, in columns and compressed, one folder a file."""
    spark, plain = t.sparkSession, F.col("account_id") % 2 == 0
    deal = F.hash("transaction_id", "branch_id", "date_text", "amount")
    n = FILES_OF_KIND
    # a row is in a file of its kind and, if it is a first line, in the bad file too
    number = F.when(plain, F.pmod(deal, F.lit(n["good"]))).when(~plain, F.pmod(deal, F.lit(n["frame"])) + n["good"])
    cols = ["transaction_id", "account_id", "date_text", "amount", "transaction_type", "branch_id"]
    packed = t.where(plain.isNotNull()).select(*cols, number.alias("file")).unionByName(
        t.where(F.col("transaction_id") % 10 == 1).select(*cols, F.lit(n["good"] + n["frame"]).alias("file")))
    packed.write.option("compression", "zstd").partitionBy("file").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    schema, first, out = t.select(*cols).schema, 0, {}
    for kind, files in n.items():
        # a kind without rows is one file of a header alone
        out[kind] = [spark.read.schema(schema).parquet(f"{path}/file={i}").coalesce(1) for i in range(first, first + files)
                     if fs.exists(hadoop(f"{path}/file={i}"))] or [spark.createDataFrame([], schema).coalesce(1)]
        first += files
    return out


def _write_files(parts: list[tuple[DataFrame, str, str, dict]]) -> None:
    """Write each frame (one partition) as the one CSV file ``name`` of ``folder``, with its options."""
    def write(df: DataFrame, folder: str, name: str, options: dict) -> None:
        spark, path = df.sparkSession, work_path(df.sparkSession, "one-file")
        df.write.option("header", True).options(**options).csv(path)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(hadoop(folder))
        for st in fs.listStatus(hadoop(path)):
            if st.getPath().getName().startswith("part-"):
                fs.rename(st.getPath(), hadoop(f"{folder}/{name}"))

    # a file is one task's work: the files are written side by side
    with ThreadPoolExecutor(max_workers=len(parts)) as pool:
        for done in [pool.submit(write, *p) for p in parts]:
            done.result()


def write_transaction_files(spark: SparkSession, sf_dir: str, base: str, id_offset: int = 0) -> str:
    """Write the test transactions as CSV files under ``base``: good files (columns reordered,
    40 extra columns, doubled quotes, mixed date texts), good files with blank header cells and
    with blanks and brackets in their names, and one file that lacks ``branch_id``.
    ``id_offset`` is added to the transaction ids."""
    t = transaction_texts(spark, sf_dir).withColumn("transaction_id", F.col("transaction_id") + id_offset)
    packed = work_path(spark, "file-rows")
    rows = _dealt(t, packed)
    good = [(_file_columns(df), f"{base}/good", f"part-{i:05d}.csv", {"escape": '"'}) for i, df in enumerate(rows["good"])]
    frame = [(_indexed_columns(df), f"{base}/from a frame", f"day {i + 1} [new].csv", {"emptyValue": ""})
             for i, df in enumerate(rows["frame"])]
    bad = [(df.select("transaction_id", "account_id", F.col("date_text").alias("transaction_date"), "amount",
                      "transaction_type"), f"{base}/bad", f"part-{i:05d}.csv", {}) for i, df in enumerate(rows["bad"])]
    _write_files([*good, *frame, *bad])
    # the packed rows have done their work, and are as many as those of the files
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    hadoop(packed).getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop(packed), True)
    return base


# Rows of one workbook of the test transactions.
ROWS_PER_WORKBOOK = 100_000


def write_transaction_workbooks(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Write the test transactions as workbooks under ``base``, among them one file that is no
    workbook (a text file of the branches under a workbook's name)."""
    t = transaction_texts(spark, sf_dir)
    books = max(4, -(-t.count() // ROWS_PER_WORKBOOK))   # a workbook is one task's work
    cells = _file_columns(t.repartition(books, "transaction_id", "branch_id", "date_text", "amount"))
    text = cells.select(*[F.col(c).cast("string").alias(c) for c in cells.columns])
    xlsx_sink.write_workbooks(text, f"{base}/books").write.parquet(work_path(spark, "workbook-listing"))
    names = adapter.source_tables(spark, sf_dir)["branch"].select("branch_name").coalesce(1)
    names.write.text(f"{base}/broken")
    _rename_parts(spark, f"{base}/broken", ".txt", lambda i: "broken.xlsx")
    return base


def rates_csv(spark: SparkSession) -> DataFrame:
    """The rate table, written as CSV and read as the banks run reads it."""
    path = work_path(spark, "rates")
    fx.rates_frame(spark).coalesce(1).write.option("header", True).csv(path)
    return fx.read_rates(spark, path)


def bank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages ``(page_id, html)`` with a table of banks, 25 to a page, made from the suppliers:
    rank, a cell with two links (flag, name), market cap with a marker after the figure; a
    header row without cells and a row without a link, which are no banks."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    row = F.format_string(
        '<tr><td> %d\n</td><td><a href="/f"><img src="f.png"></a> <a href="/b">%s</a></td><td>%.2f*\n</td></tr>',
        F.col("s_suppkey"), F.col("s_name"), F.col("s_acctbal"))
    rows = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", row.alias("row")))),
                                    lambda x: x["row"]), "")
    return (s.groupBy(F.floor((F.col("s_suppkey") - 1) / 25).alias("page_id")).agg(rows.alias("rows"))
            .select("page_id", F.concat(
                F.lit("<html><body><table><tbody><tr><th>Rank</th><th>Bank name</th><th>Cap</th></tr>"), "rows",
                F.lit("<tr><td>-</td><td>total</td><td>0*</td></tr></tbody></table><table><tbody><tr><td>1</td>"
                      '<td><a href="/z">other table</a></td><td>9*</td></tr></tbody></table></body></html>')).alias("html")))
