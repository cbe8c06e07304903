"""Equal rows as one row and a count.

Row-level results keep every copy, but copies need not travel: counting them
combines before the shuffle, so a row that makes up a third of a table is one
row per map task afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
_CHUNK = 100_000


def collapse(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def replicate(df: DataFrame, chunk: int = _CHUNK) -> DataFrame:
    """Undo ``collapse``.

    Every row is cut into chunks of its copies (one for nearly all), the chunks are spread by row and
    number, and each is repeated where it lands. The number of partitions is given, so that adaptive
    execution does not merge the few chunks before they grow.
    """
    last = F.expr(f"({COPIES} - 1) div {chunk}")
    cut = (df.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
           .withColumn(COPIES, F.least(F.lit(chunk), F.col(COPIES) - F.col("_part") * chunk)))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = cut.repartition(partitions, *[F.col(f"`{name}`") for name in cut.columns])
    return (spread.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES))))
            .drop("_n", "_part", COPIES))
