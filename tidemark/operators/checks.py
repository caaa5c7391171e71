"""Integrity checks as tables of violations; ``require_none`` turns one into an error before anything is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.projections import KEYS


class IntegrityError(ValueError):
    pass


def require_none(violations: DataFrame, what: str) -> None:
    """Raise if there is a violation."""
    first = violations.limit(5).collect()
    if first:
        raise IntegrityError(f"{what}: {[r.asDict() for r in first]}")


def with_previous(df: DataFrame, columns: list[str], keys: list[str], order: str = "capture_seq", size: int = 1 << 20) -> DataFrame:
    """``df`` with ``prev_<c>`` of the row before in ``order`` (an integer), in two levels: inside pieces and across them."""
    cut = df.withColumn("__c", F.floor(F.col(order) / F.lit(size)).cast("long"))
    ends = cut.groupBy(*keys, "__c").agg(F.max_by(F.struct(*columns), order).alias("__end"))
    ends = ends.withColumn("__carry", F.lag("__end").over(Window.partitionBy(*keys).orderBy("__c"))).drop("__end")
    w = Window.partitionBy(*keys, "__c").orderBy(order)
    out = cut.join(ends, [*keys, "__c"]).withColumn("__p", F.coalesce(F.lag(F.struct(*columns)).over(w), F.col("__carry")))
    return out.withColumns({f"prev_{c}": F.col("__p")[c] for c in columns}).drop("__c", "__carry", "__p")


def sequence_violations(df: DataFrame, keys: list[str] = ["capture_session_id"]) -> DataFrame:  # noqa: B006
    """Repeated capture_seq, clock going back, and gaps in the sequence, with the rows they are at."""
    repeated = df.groupBy(*keys, "capture_seq").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, "capture_seq", F.lit("DUPLICATE").alias("error"))
    prev = with_previous(df.select(*keys, "capture_seq", "monotonic_ns"), ["capture_seq", "monotonic_ns"], keys)
    kinds = F.array_compact(F.array(F.when(F.col("monotonic_ns") < F.col("prev_monotonic_ns"), F.lit("CLOCK_BACK")), F.when(F.col("capture_seq") > F.col("prev_capture_seq") + 1, F.lit("GAP"))))
    return repeated.unionByName(prev.select(*keys, "capture_seq", F.explode(kinds).alias("error")))


def continuity_violations(depth: DataFrame, generation: str = "generation", keys: list[str] = KEYS) -> DataFrame:
    """Depth events whose previous id isn't the id before them in the same generation."""
    prev = with_previous(depth.select(*keys, generation, "capture_seq", "previous_id", "final_id"), ["final_id"], [*keys, generation])
    return prev.where("prev_final_id is not null and previous_id <> prev_final_id").select(*keys, "capture_seq", F.col("prev_final_id").alias("expected"), "previous_id")


def invariant_errors(features: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A row per broken invariant: keys, capture_seq, error.  ``rules``: name to the condition of a violation."""
    names = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return features.select(*KEYS, "capture_seq", F.explode(names).alias("error"))


def field_differences(actual: DataFrame, recorded: DataFrame, keys: list[str], exact: list[str], close: list[str], tolerance: float = 1e-12) -> DataFrame:
    """keys and ``differs``: names of the fields that are not equal, or not within the absolute tolerance; ``missing`` rows too."""
    a = actual.select(*keys, *[F.col(c).alias(f"a_{c}") for c in exact + close], F.lit(True).alias("in_a"))
    b = recorded.select(*keys, *[F.col(c).alias(f"b_{c}") for c in exact + close], F.lit(True).alias("in_b"))
    both = a.join(b, keys, "full")
    tests = [F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in exact]
    tests += [F.when(~F.coalesce(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) <= tolerance, F.col(f"a_{c}").isNull() & F.col(f"b_{c}").isNull()), F.lit(c)) for c in close]
    lost = F.when(F.col("in_a").isNull() | F.col("in_b").isNull(), F.array(F.lit("missing")))
    return both.select(*keys, F.coalesce(lost, F.array_compact(F.array(*tests))).alias("differs")).where(F.size("differs") > 0)


def content_equal(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def reconciled(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """keys, expected and actual row counts that differ."""
    e, t = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for d, n in ((source, "expected"), (target, "actual")))
    return e.join(t, keys, "full").fillna(0, ["expected", "actual"]).where("expected <> actual")
