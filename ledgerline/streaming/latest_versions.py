"""Daily totals of a transaction stream in which ids repeat: each transaction counts once, with its
latest version.

A second stream follows the rows that the file-drop stream staged. Its state, keyed by blocks of
``BLOCK`` consecutive transaction ids (so no day, however busy, is one task's), holds the version of
each id that counts now; a block is read and written once an epoch, which saves a call to the state
store for every id. A row that wins against its id's version takes its place, and the change leaves the operator as signed amounts: the old
version's day and amount out, the new one's in. An epoch therefore reads its own new rows only;
the totals per day are brought up to date by the changes (``file_ingest.add_to_totals``). State and
offsets are in the checkpoint: a stream that is stopped goes on from there.

The version that counts does not depend on the order of arrival: it is the first one in
``operators.dedup.latest_transaction_order`` (newest date, larger amount, smaller branch, type).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerline.schemas import MONEY
from ledgerline.streaming.file_ingest import STAGED_SCHEMA, add_to_totals, epoch_key, read_totals

VERSION = "transaction_date timestamp_ntz, amount double, branch_id long, transaction_type string"
BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS   # ids of one entry of the state: bounds its size, whatever the ids are
STATE = f"versions array<struct<transaction_id long, {VERSION}>>"
CHANGE = "day date, n int, amount double"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def before(a: tuple, b: tuple) -> bool:
    """Whether version ``a`` comes before ``b`` in the order of versions (columns of ``VERSION``)."""
    for x, y, descending in zip(a, b, (True, True, False, False)):
        if x != y:
            if x is None or y is None:   # nulls: last in a descending order, first in an ascending one
                return (y is None) == descending
            return (x > y) == descending
    return False


class LatestVersion(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counted = handle.getValueState("versions", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.counted.get()
        old = {v[0]: tuple(v[1:]) for v in held[0]} if held is not None else {}
        new: dict[int, tuple] = {}
        for r in rows:
            n, *version = r[:5]
            version, best = tuple(version), new.get(n, old.get(n))
            if best is None or before(version, best):
                new[n] = version
        if new:
            self.counted.update(([(n, *v) for n, v in {**old, **new}.items()],))
        for n, best in new.items():
            if n in old:
                yield Row(day=old[n][0].date(), n=-1, amount=old[n][1])
            yield Row(day=best[0].date(), n=1, amount=best[1])

    def close(self) -> None:
        pass


def _changes_per_day(changes: DataFrame) -> DataFrame:
    amount = F.coalesce(F.col("amount").cast(MONEY), F.lit(0).cast(MONEY)) * F.col("n")
    return changes.groupBy(F.col("day").alias("TransactionDate")).agg(
        F.sum("n").cast("long").alias("TotalTransactions"), F.sum(amount).cast(MONEY).alias("TotalTransactionAmount"))


def run_daily_totals(spark: SparkSession, staged_dir: str, out_dir: str, checkpoint: str, max_files: int = 1000) -> None:
    """Bring the totals under ``out_dir`` up to date with the rows staged since the last call."""
    rows = (spark.readStream.schema(STAGED_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(staged_dir)
            .where("transaction_id is not null and transaction_date is not null")
            .select("transaction_id", "transaction_date", "amount", "branch_id", "transaction_type",
                    F.shiftright("transaction_id", BLOCK_BITS).alias("block"), F.lit(BLOCK_BITS).alias("bits")))
    # two key columns: a state of the earlier, smaller blocks has one, and is refused instead of misread
    changes = rows.groupBy("block", "bits").transformWithState(LatestVersion(), CHANGE, "Append", "None")

    def process(batch: DataFrame, epoch_id: int) -> None:
        stream_id, name = epoch_key(batch.sparkSession, checkpoint, epoch_id)
        add_to_totals(_changes_per_day(batch), out_dir, stream_id, name)

    earlier = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)   # the operator needs it; a query takes it from the session as it starts
    try:
        query = (changes.writeStream.outputMode("append").foreachBatch(process)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        if earlier is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, earlier)


def read_daily_totals(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_totals(spark, out_dir)
