"""The row nearest to an instant, within a tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.projections import KEYS

from .series import CHUNK_NS, at_home, backward_window, chunk_window, chunked, upto


def nearest(targets: DataFrame, rows: DataFrame, tolerance_ns: int, columns: list[str], keys: list[str] = KEYS, chunk_ns: int = CHUNK_NS) -> DataFrame:
    """``targets`` (keys, monotonic_ns, ...) with ``near_ns`` and ``columns`` of the row of ``rows`` nearest in time, NULL if none is
    within ``tolerance_ns``.  Of two rows equally far the earlier one wins, of rows of one instant the lowest capture_seq.

    The latest row before and the first one after come from one window per chunk of the clock.
    """
    names = targets.columns
    one = rows.groupBy(*keys, "monotonic_ns").agg(F.min_by(F.struct(F.col("monotonic_ns").alias("near_ns"), *columns), "capture_seq").alias("__r"))
    asked = targets.select(*keys, "monotonic_ns", F.struct(*[F.col(c) for c in names]).alias("__t"))
    both = chunked(asked.unionByName(one, allowMissingColumns=True), tolerance_ns, tolerance_ns, chunk_ns=max(chunk_ns, tolerance_ns))
    before = F.last("__r", ignorenulls=True).over(upto(chunk_window(keys), 0))
    after = F.last("__r", ignorenulls=True).over(upto(backward_window(keys), -1))
    t = F.col("monotonic_ns")
    before, after = F.when(before["near_ns"] >= t - tolerance_ns, before), F.when(after["near_ns"] <= t + tolerance_ns, after)
    out = at_home(both.withColumns({"__before": before, "__after": after})).where("__t is not null")
    later = F.col("__after").isNotNull() & (F.col("__before").isNull() | (F.col("__after.near_ns") - F.col("monotonic_ns") < F.col("monotonic_ns") - F.col("__before.near_ns")))
    return out.withColumn("__n", F.when(later, F.col("__after")).otherwise(F.col("__before"))).select("__t.*", "__n.*")
