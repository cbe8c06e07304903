"""Ledger side: gateway link, sign, keys, same-day refunds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acerto.config import INTERNAL_TRANSFER, PIX_IN, PIX_OUT, SOURCE_LEDGER, ReconConfig
from acerto.functions import join_text, local_day, pix_key, tx_key
from acerto.operators.counted import COPIES, collapse, replicate
from acerto.sources.scratch import new_folder, until_end

BASE_COLUMNS = ("date_day", "end_to_end_id", "operation", "amount")


def ledger_gateway_join(ledger: DataFrame, gateway: DataFrame) -> DataFrame:
    """Attach the end-to-end id; a transfer with several links gives several rows."""
    return ledger.join(gateway, F.col("transfer_id") == F.col("ledger_transfer_id"), "inner")


def ledger_day_range(ledger: DataFrame, config: ReconConfig) -> DataFrame:
    """Local day between the ledger start and yesterday, inclusive.

    The range on the raw column is a day wider on both ends than any zone needs;
    it adds nothing to the result but reaches the file scan.
    """
    raw = F.col("utc_datetime")
    earliest = F.lit(config.ledger_start - timedelta(days=1)).cast("timestamp_ntz")
    latest = F.date_add(config.as_of_day(), 1).cast("timestamp_ntz")
    day = local_day(raw, config.zone)
    return ledger.filter((raw >= earliest) & (raw < latest)
                         & day.between(F.lit(config.ledger_start), config.yesterday()))


def exclude_accounts(ledger: DataFrame, accounts: tuple | list | DataFrame) -> DataFrame:
    """Rows outside the account list; rows without an account go as well.

    A long list comes as a one-column DataFrame and is anti-joined.
    """
    known = ledger.filter(F.col("account_id").isNotNull())
    if isinstance(accounts, DataFrame):
        listed = accounts.toDF("account_id").distinct()
        return known.join(listed, "account_id", "left_anti")
    return known.filter(~F.col("account_id").isin(*accounts)) if accounts else known


def internal_transfer_filter(transactions: DataFrame) -> DataFrame:
    """Anything but an internal transfer; a missing operation stays."""
    operation = F.col("operation")
    return transactions.filter((operation != INTERNAL_TRANSFER) | operation.isNull())


def signed_by_direction(direction: Column, amount: Column, config: ReconConfig) -> Column:
    """Out negative, in positive, NULL for any other direction."""
    sign = (F.when(direction == config.direction_out, F.lit(-1))
            .when(direction == config.direction_in, F.lit(1)))
    return sign * amount


def signed_rows(ledger: DataFrame, config: ReconConfig) -> DataFrame:
    """Ledger rows that count: transfer, local day, operation, signed amount."""
    wanted = (ledger.filter(F.col("type").isin(PIX_IN, PIX_OUT))
              .transform(ledger_day_range, config)
              .transform(exclude_accounts, config.excluded_accounts))
    return wanted.select(
        "transfer_id",
        local_day(F.col("utc_datetime"), config.zone).alias("date_day"),
        F.col("type").alias("operation"),
        signed_by_direction(F.col("direction"), F.col("amount"), config).alias("sided_amount"))


def linked_rows(signed: DataFrame, gateway: DataFrame) -> DataFrame:
    """Signed ledger rows with the ids of their transfers: local day, id, operation, signed amount, source."""
    return (ledger_gateway_join(signed, gateway.select("ledger_transfer_id", "end_to_end_id"))
            .select("date_day", "end_to_end_id", "operation", "sided_amount",
                    F.lit(SOURCE_LEDGER).alias("source")))


def ledger_transactions_aux(ledger: DataFrame, gateway: DataFrame,
                            config: ReconConfig) -> DataFrame:
    """Linked ledger rows of the window: local day, id, operation, signed amount, source.

    Filters and projections come before the join, so only five narrow columns
    and the rows that count are shuffled.
    """
    return linked_rows(signed_rows(ledger, config), gateway)


def heavy_transfers(ledger: DataFrame, gateway: DataFrame, least: int) -> DataFrame | None:
    """Transfers with over ``least`` rows on both sides, whose pairs would be many; None if there are none.

    All other transfers make at most ``least`` pairs for each row of the larger side. Runs a job over the one column
    of the links and, only if some transfer has that many, one over the ledger's; the result is a written table.
    """
    def counted(rows: DataFrame, column: str) -> DataFrame:
        return (rows.groupBy(F.col(column).alias("transfer_id")).agg(F.count("*").alias("n"))
                .filter((F.col("n") > least) & F.col("transfer_id").isNotNull()).select("transfer_id"))

    linked = counted(gateway, "ledger_transfer_id")
    if linked.isEmpty():
        return None
    spark = ledger.sparkSession
    path = new_folder(spark, "heavy-transfers")
    counted(ledger, "transfer_id").join(linked, "transfer_id", "left_semi").write.parquet(path)
    found = spark.read.parquet(until_end(spark, path))
    return None if found.isEmpty() else found


def with_keys(base: DataFrame) -> DataFrame:
    """Add the source and the three text keys to (day, id, operation, amount) rows."""
    key = pix_key(F.col("end_to_end_id"), F.col("amount"))
    return base.select(
        *BASE_COLUMNS, F.lit(SOURCE_LEDGER).alias("source"),
        key.alias("pix_key"),
        tx_key(key, F.col("date_day")).alias("tx_key"),
        join_text("end_to_end_id", F.lit(","), F.col("date_day").cast("string"))
        .alias("same_day_refund_ledger_key"),
        *[name for name in base.columns if name == COPIES])


def ledger_transactions(aux: DataFrame) -> DataFrame:
    return aux.withColumnRenamed("sided_amount", "amount").transform(with_keys)


def same_day_refunds(transactions: DataFrame) -> DataFrame:
    """(id, day) groups whose amounts add up to zero.

    Sums without any amount are NULL and do not qualify; a single zero amount does.
    """
    return (transactions.groupBy("end_to_end_id", "same_day_refund_ledger_key")
            .agg(F.sum("amount").alias("amount")).filter(F.col("amount") == 0))


# A missing id has no partner in the join below: it is told apart from the empty text by this
# second key, which also spreads the rows without an id over the tasks.
_NO_ID_GROUPS = 4096


def _refunded_ids(counted: DataFrame) -> DataFrame:
    """Ids with a refund on some day, each once.

    No filter on the id here: it would move below the aggregate and keep Spark
    from reusing the shuffle of ``counted``.
    """
    present = F.when(F.col("end_to_end_id").isNull(), F.lit(-1)).otherwise(F.lit(0))
    return (counted.groupBy("end_to_end_id", "date_day")
            .agg(F.sum(F.col("amount") * F.col(COPIES)).alias("total"))
            .filter(F.col("total") == 0)
            .select(F.coalesce("end_to_end_id", F.lit("")).alias("_id"),
                    present.cast("bigint").alias("_group")).distinct())


def net_refunds_counted(transactions: DataFrame) -> DataFrame:
    """Ledger rows of ids without any same-day refund, equal rows counted in ``copies``.

    A refund on one day removes the id on all days. Counting first gives both
    uses of the ledger (finding refunds, removing ids) the same shuffle, which
    Spark then runs once.
    """
    counted = collapse(transactions.select(*BASE_COLUMNS))
    group = F.when(
        F.col("end_to_end_id").isNull(),
        F.pmod(F.xxhash64("date_day", "amount", "operation"), F.lit(_NO_ID_GROUPS)) + 1)
    left = counted.select("*", F.coalesce("end_to_end_id", F.lit("")).alias("_id"),
                          F.coalesce(group, F.lit(0)).alias("_group"))
    return (left.join(_refunded_ids(counted), ["_id", "_group"], "left_anti")
            .select(*counted.columns).transform(with_keys))


def ledger_net_refunds(transactions: DataFrame) -> DataFrame:
    """As ``net_refunds_counted``, one row per transaction."""
    return replicate(net_refunds_counted(transactions))
