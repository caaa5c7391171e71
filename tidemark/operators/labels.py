"""Forward labels and the purged chronological split.

A label's target is the first observation at or after the horizon.  A gap of more than three
seconds voids it, so the target lies in a bounded frame; labels also end at invalid rows and at
integrity boundaries.  Excursions are taken over the path up to and including the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.projections import KEYS

from .series import SECOND, at_home, backward_window, chunk_window, chunked, ranked, upto

GAP_NS = 3 * SECOND
HORIZONS = {"250ms": SECOND // 4, "500ms": SECOND // 2, "1s": SECOND, "2s": 2 * SECOND, "5s": 5 * SECOND, "10s": 10 * SECOND}
EXCURSIONS = ("1s", "2s", "5s")


def forward_labels(
    mids: DataFrame,
    bounds: DataFrame | None = None,
    horizons: dict[str, int] = HORIZONS,
    excursions: tuple[str, ...] = EXCURSIONS,
    price: str = "price",
    valid: str = "feature_valid",
) -> DataFrame:
    """``mids`` with ``future_return_<h>`` and ``future_max_up_bps_<h>`` / ``future_max_down_bps_<h>``.

    ``bounds`` (keys, monotonic_ns): instants no label crosses; one at the row's own instant counts as passed.
    """
    longest = max(horizons.values()) + GAP_NS
    rows = mids.withColumn("__bound", F.lit(0))
    if bounds is not None:
        marks = bounds.select(*KEYS, "monotonic_ns").distinct().select(*KEYS, "monotonic_ns", F.lit(1).alias("__bound"))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    starts = mids.groupBy(*KEYS).agg(F.min("monotonic_ns").alias("__start"))
    cut = chunked(rows, GAP_NS + 1, longest)
    w = chunk_window()
    mark = F.col("__bound") == 1
    mid_ns = F.when(~mark, F.col("monotonic_ns"))
    before = F.last(mid_ns, ignorenulls=True).over(upto(w, -1))
    cut = cut.withColumn("__before", before).join(starts, KEYS, "left")
    gap = (F.col("monotonic_ns") > F.col("__start")) & (F.coalesce(F.col("monotonic_ns") - F.col("__before"), F.lit(GAP_NS + 1)) > GAP_NS)
    flag = F.when(mark, 0).otherwise((gap | ~F.col(valid)).cast("int"))
    cut = cut.withColumn("__flag", flag)
    cut = cut.withColumns({"__bad": F.sum("__flag").over(upto(w, 0)), "__passed": F.sum("__bound").over(upto(w, 0)), "__mid": F.when(~mark, F.col(price).cast("double"))})
    # of observations of one instant the first one captured is the target
    target = F.when(~mark, F.struct(F.col("monotonic_ns").alias("ns"), F.col("capture_seq").alias("seq"), F.col("__mid").alias("p"), F.col("__bad").alias("bad"), F.col("__passed").alias("passed")))
    cut = cut.withColumn("__target", target)
    for n in excursions:
        cut = _extremes(cut, n, horizons[n])
    later = backward_window()
    hits = {f"__t_{n}": F.min("__target").over(upto(later, -h)) for n, h in horizons.items()}
    for n in excursions:
        own, far = F.col(f"__own_{n}"), F.last(f"__far_{n}", ignorenulls=True).over(upto(w, horizons[n] - 1))
        # the path ends in its row's own stretch, or in the next one
        far = F.when(far["stretch"] > F.floor(F.col("monotonic_ns") / F.lit(horizons[n])), far)
        hits[f"__hi_{n}"], hits[f"__lo_{n}"] = F.greatest(own["hi"], far["hi"]), F.least(own["lo"], far["lo"])
    cut = cut.withColumns(hits).where(~mark)
    made = {}
    for n, h in horizons.items():
        t = F.col(f"__t_{n}")
        near = t["ns"] <= F.col("monotonic_ns") + F.lit(h + GAP_NS)
        ok = near & (t["bad"] == F.col("__bad") - F.col("__flag")) & (t["passed"] == F.col("__passed"))
        made[f"future_return_{n}"] = F.when(ok, F.log(t["p"] / F.col("__mid")))
        if n in excursions:
            up, down = F.greatest(t["p"], F.col(f"__hi_{n}")), F.least(t["p"], F.col(f"__lo_{n}"))
            made[f"future_max_up_bps_{n}"] = F.when(ok, F.log(up / F.col("__mid")) * 10000)
            made[f"future_max_down_bps_{n}"] = F.when(ok, F.log(down / F.col("__mid")) * 10000)
    return at_home(cut.withColumns(made)).select(*mids.columns, *made)


def _extremes(cut: DataFrame, name: str, horizon: int) -> DataFrame:
    """``cut`` with extremes inside stretches of the clock as long as the horizon: ``__own_<name>`` of what follows a row in its
    stretch, ``__far_<name>`` of what comes in it up to and including the row's instant."""
    cut = cut.withColumn("__stretch", F.floor(F.col("monotonic_ns") / F.lit(horizon)))
    stretch = Window.partitionBy(*KEYS, "chunk", "__stretch")
    ends = lambda w: F.struct(F.max("__mid").over(w).alias("hi"), F.min("__mid").over(w).alias("lo"), F.col("__stretch").alias("stretch"))
    own = ends(upto(stretch.orderBy(F.col("monotonic_ns").desc()), -1))
    far = ends(upto(stretch.orderBy("monotonic_ns"), 0))
    return cut.withColumns({f"__own_{name}": own, f"__far_{name}": far}).drop("__stretch")


def civil_range_labels(mids: DataFrame, inside: Column, bounds: DataFrame, horizons: dict[str, int] = HORIZONS, excursions: tuple[str, ...] = ()) -> DataFrame:
    """Labels of the rows where ``inside`` holds.  The others stay in the series, and no label reaches across one."""
    inside = F.coalesce(inside, F.lit(False))
    left_out = mids.where(~inside).select(*KEYS, "monotonic_ns")
    return forward_labels(mids, bounds.select(*KEYS, "monotonic_ns").unionByName(left_out), horizons, excursions).where(inside)


def chronological_split(rows: DataFrame, purge_ns: int, train: float = 0.6, validation: float = 0.2, keys: list[str] = KEYS) -> DataFrame:
    """``rows`` with ``part`` (train, validation, test); rows whose horizon reaches past their part's end are left out."""
    placed = ranked(rows, ["monotonic_ns", "capture_seq"], keys).withColumn("__i", F.col("rn") - 1)
    first = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(train)).cast("long"))
    second = F.greatest(first + 1, F.floor(F.col("n") * F.lit(train + validation)).cast("long"))
    placed = placed.withColumns({"__c1": first, "__c2": second})
    ends = placed.groupBy(*keys).agg(
        F.max(F.when(F.col("__i") == F.col("__c1") - 1, F.col("monotonic_ns"))).alias("__e1"), F.max(F.when(F.col("__i") == F.col("__c2") - 1, F.col("monotonic_ns"))).alias("__e2")
    )
    part = F.when(F.col("__i") < F.col("__c1"), "train").when(F.col("__i") < F.col("__c2"), "validation").otherwise("test")
    end = F.when(F.col("part") == "train", F.col("__e1")).when(F.col("part") == "validation", F.col("__e2"))
    joined = placed.withColumn("part", part).join(ends, keys)
    return joined.where(end.isNull() | (F.col("monotonic_ns") + F.lit(purge_ns) <= end)).select(*rows.columns, "part")


def label_value(name: str, df: DataFrame) -> Column:
    """A label of ``df`` by name, as a double; a name that isn't a label's is an error."""
    if not name.startswith("future_") or name not in df.columns:
        raise KeyError(f"unknown label {name}")
    return F.col(name).cast("double").alias(name)
