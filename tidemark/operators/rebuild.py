"""Order books at any instant without a fold: every level update holds until the next one at its price.

A generation (from one bootstrap to the next or to a lifecycle row) is cut into chunks of a fixed number of rows.  A
chunk starts from the levels that are open there (the last quantity of each price before it), and a level's
validity ends at the next change of its price inside the chunk.  The top n at an instant is an interval join inside the chunk.
Levels that stay open through a whole chunk bound what can be among the best n at any instant of it, so only
levels that are as good as the n-th of them are joined.

The checks after each update are questions of the same kind: an empty side and a crossed book show in the best
levels, and how many levels are left in the snapshot's range is a running sum of openings and closings.  The first
fault of a generation ends its book, so nothing after it needs to be known.

All windows are over (generation, chunk) or (price, chunk): one long generation is as many tasks as it has chunks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_table
from tidemark.sources.projections import KEYS

from .series import last_before, running_sum

#: Rows of a generation in a chunk: open levels are copied once a chunk, and inside it intervals meet instants.
CHUNK_ROWS = 512
#: Levels that must be left in the range of a snapshot that was cut at its limit.
COVER_LEVELS = 10
#: Buffered updates stand behind their bootstrap; there are fewer than this many.
PLACES = 1 << 16
GENERATION = [*KEYS, "generation"]
NO_BOOK = "no synchronized book"


def bridges(first_id: Column, final_id: Column, snapshot_id: Column) -> Column:
    """Whether a diff spans a snapshot's update id."""
    return (first_id <= snapshot_id) & (final_id >= snapshot_id)


def _levels(side: str) -> Column:
    return F.coalesce(F.col(side), F.array().cast("array<struct<price:decimal(18,8),quantity:decimal(18,8)>>"))


def _bad_snapshot() -> Column:
    """Why a bootstrap's levels aren't a book; null if they are."""
    prices = {s: F.transform(_levels(s), lambda x: x["price"]) for s in ("bids", "asks")}
    wrong = F.exists(F.concat(_levels("bids"), _levels("asks")), lambda x: ~F.coalesce((x["price"] > 0) & (x["quantity"] > 0), F.lit(False)))
    twice = (F.size(F.array_distinct(prices["bids"])) < F.size(prices["bids"])) | (F.size(F.array_distinct(prices["asks"])) < F.size(prices["asks"]))
    empty = (F.size(prices["bids"]) == 0) | (F.size(prices["asks"]) == 0)
    return F.when(wrong | twice, "bad snapshot level").when(empty, "empty side").when(F.array_max(prices["bids"]) >= F.array_min(prices["asks"]), "crossed")


def _bad_levels() -> Column:
    return F.exists(F.concat(_levels("bids"), _levels("asks")), lambda x: ~F.coalesce((x["price"] > 0) & (x["quantity"] >= 0), F.lit(False)))


@dataclass
class Chain:
    """``rows``: bootstraps, updates that apply, recorded books and their generations, up to each generation's first fault that
    the rows themselves show; ``faults`` (generation, pos, reason, gap): those faults; ``snapshots``: per
    generation its bootstrap's place, ids and the bounds of its range."""

    rows: DataFrame
    faults: DataFrame
    snapshots: DataFrame


def _marked(events: DataFrame) -> DataFrame:
    """``events`` with ``generation`` (new at bootstraps and lifecycle rows) and ``connection`` (new at lifecycle rows)."""
    marked = running_sum(events, F.col("kind").isin("bootstrap", "lifecycle").cast("long"), "generation")
    return shared_table(running_sum(marked, (F.col("kind") == "lifecycle").cast("long"), "connection"), "book-events")


def _placed(marked: DataFrame) -> DataFrame:
    """Rows of generations with a bootstrap, in the order of ``pos``: buffered updates stand behind the bootstrap
    that names them, or a row of kind ``missing`` where there is none."""
    boots = marked.where("kind = 'bootstrap'")
    asked = boots.select(*GENERATION, "connection", F.col("capture_seq").alias("at"), F.posexplode("buffered_ids").alias("place", "final_id"))
    held = marked.where("kind = 'depth'").select(*KEYS, "connection", "final_id", F.struct("first_id", "previous_id", "bids", "asks", F.col("capture_seq").alias("seq")).alias("u"))
    # of several rows of one id the last one captured before the bootstrap counts
    found = asked.join(held, [*KEYS, "connection", "final_id"], "left").withColumn("u", F.when(F.col("u.seq") < F.col("at"), F.col("u")))
    found = found.groupBy(*GENERATION, "at", "place", "final_id").agg(F.max_by("u", F.col("u.seq")).alias("u"))
    buffered = found.select(
        *GENERATION, F.col("at").alias("capture_seq"), F.when(F.col("u").isNull(), "missing").otherwise("depth").alias("kind"), (F.col("place") + 1).alias("place"),
        "final_id", "u.first_id", "u.previous_id", "u.bids", "u.asks",
    )
    rows = marked.where("kind <> 'lifecycle'").withColumn("place", F.lit(0)).select(*buffered.columns).unionByName(buffered)
    return rows.withColumn("pos", F.col("capture_seq") * PLACES + F.col("place"))


def chain(marked: DataFrame) -> Chain:
    """Which updates apply to which bootstrap, worked out by joins, sums and last values in two levels."""
    size = F.size(_levels("bids")), F.size(_levels("asks"))
    ends = [F.when(n >= F.col("snapshot_limit"), f(F.transform(_levels(s), lambda x: x["price"]))) for n, s, f in zip(size, ("bids", "asks"), (F.array_min, F.array_max), strict=True)]
    snapshots = marked.where("kind = 'bootstrap'").select(*GENERATION, F.col("final_id").alias("anchor"), ends[0].alias("low"), ends[1].alias("high"))
    rows = shared_table(_placed(marked).join(snapshots.select(*GENERATION, "anchor"), GENERATION), "book-rows")
    first = rows.where("kind = 'depth' and final_id >= anchor").groupBy(*GENERATION).agg(F.min("pos").alias("reach"))
    snapshots = shared_table(snapshots.join(first, GENERATION, "left"), "book-snapshots")
    rows = rows.join(snapshots.select(*GENERATION, "reach"), GENERATION)
    counts = (F.col("kind") == "depth") & F.coalesce(F.col("pos") >= F.col("reach"), F.lit(False))
    rows = last_before(rows, F.when(counts, F.col("final_id")), "made_id", GENERATION, "pos", PLACES << 20)
    reached = F.coalesce(F.col("pos") > F.col("reach"), F.lit(False))
    applies = counts & ~F.coalesce(reached & (F.col("final_id") == F.col("made_id")), F.lit(False))
    follows = F.when(reached, F.col("previous_id") == F.col("made_id")).otherwise(bridges(F.col("first_id"), F.col("final_id"), F.col("anchor")))
    wrong = applies & ~F.coalesce(follows, F.lit(False))
    reason = (
        F.when(F.col("kind") == "bootstrap", F.concat(F.lit("invalid bootstrap: "), _bad_snapshot()))
        .when(F.col("kind") == "missing", F.concat(F.lit("missing buffered depth event "), F.col("final_id").cast("string")))
        .when(wrong, F.lit(NO_BOOK))
        .when(applies & _bad_levels(), F.lit("invalid depth: bad level"))
    )
    rows = shared_table(rows.withColumns({"applies": applies, "reason": reason, "gap": wrong & reached}).drop("anchor"), "book-chain")
    faults = rows.where("reason is not null").groupBy(*GENERATION).agg(F.min("pos").alias("pos"), F.min_by("reason", "pos").alias("reason"), F.min_by("gap", "pos").alias("gap"))
    faults = shared_table(faults, "book-faults")
    sound = rows.join(faults.select(*GENERATION, F.col("pos").alias("end")), GENERATION, "left").where("end is null or pos < end")
    return Chain(sound.where("applies or kind in ('bootstrap', 'trusted')").drop("end", "reason", "gap"), faults, snapshots)


def _intervals(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(levels (generation, chunk, side, price, o, quantity, since, until, stable) of ``rows``, which have ``chunk``;
    how far each chunk looks: n).  ``since`` is -1 for levels open at the chunk's start; ``o`` orders prices, best first."""
    side = lambda s, name: F.transform(_levels(s), lambda x, i: F.struct(F.lit(name).alias("side"), i.alias("place"), x["price"].alias("price"), x["quantity"].alias("quantity")))
    changes = rows.where("kind <> 'trusted'").select(*GENERATION, "chunk", "kind", "pos", F.explode(F.concat(side("bids", "bid"), side("asks", "ask"))).alias("l"))
    changes = changes.select(*GENERATION, "chunk", "kind", "pos", "l.*")
    level = [*GENERATION, "side", "price"]
    lasts = changes.groupBy(*level, "chunk").agg(F.max_by("quantity", F.struct("pos", "place")).alias("quantity"))
    chunks = rows.groupBy(*GENERATION, "chunk").agg(F.max(F.when(F.col("kind") == "trusted", F.greatest(F.size(_levels("bids")), F.size(_levels("asks"))))).alias("n"))
    chunks = chunks.select(*GENERATION, "chunk", F.greatest(F.col("n"), F.lit(1)).alias("n"))
    reach = chunks.groupBy(*GENERATION).agg(F.max("chunk").alias("last_chunk"))
    following = F.lead("chunk").over(Window.partitionBy(*level).orderBy("chunk"))
    open_until = lasts.withColumn("next", following).join(reach, GENERATION).withColumn("next", F.coalesce("next", "last_chunk"))
    held = open_until.where("quantity > 0 and next > chunk").select(*level, "quantity", F.explode(F.sequence(F.col("chunk") + 1, F.col("next"))).alias("chunk"))
    opening = held.unionByName(changes.where("kind = 'bootstrap'").select(*level, "quantity", "chunk")).select(*level, "chunk", "quantity", F.lit(-1).cast("long").alias("since"), F.lit(-1).alias("place"))
    inside = opening.unionByName(changes.where("kind = 'depth'").select(*level, "chunk", "quantity", F.col("pos").alias("since"), "place"))
    one = Window.partitionBy(*level, "chunk")
    inside = inside.withColumn("until", F.lead("since").over(one.orderBy("since", "place")))
    inside = inside.withColumn("stable", (F.min("quantity").over(one) > 0) & (F.min("since").over(one) == -1))
    o = F.when(F.col("side") == "bid", -F.col("price")).otherwise(F.col("price"))
    return inside.where("quantity > 0 and (until is null or until > since)").withColumn("o", o).drop("place"), chunks


def _near(levels: DataFrame, chunks: DataFrame) -> DataFrame:
    """The levels that can be among the best n of their chunk."""
    side = [*GENERATION, "chunk", "side"]
    stable = levels.where("stable and since = -1").join(chunks, [*GENERATION, "chunk"])
    bounds = stable.withColumn("rn", F.row_number().over(Window.partitionBy(*side).orderBy("o"))).where("rn = n").select(*side, F.col("o").alias("bound"))
    return levels.join(bounds, side, "left").where("bound is null or o <= bound").drop("bound", "stable")


def _covered(levels: DataFrame, asked: DataFrame, snapshots: DataFrame) -> DataFrame:
    """``asked`` (generation, chunk, pos) with how many levels of each side are in the snapshot's range."""
    chunk = [*GENERATION, "chunk"]
    inside = levels.join(snapshots.where("low is not null or high is not null"), GENERATION)
    inside = inside.where("(side = 'bid' and price >= low) or (side = 'ask' and price <= high)")
    step = F.explode(F.array(F.struct(F.col("since").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("until").alias("pos"), F.lit(-1).alias("d")))).alias("s")
    steps = inside.select(*chunk, "side", step).where("s.pos is not null").select(*chunk, F.col("s.pos").alias("pos"), *[F.when(F.col("side") == s, F.col("s.d")).otherwise(0).alias(f"{s}s_in") for s in ("bid", "ask")])
    nothing = asked.select(*chunk, "pos", F.lit(0).alias("bids_in"), F.lit(0).alias("asks_in"))
    at = steps.unionByName(nothing).groupBy(*chunk, "pos").agg(F.sum("bids_in").alias("bids_in"), F.sum("asks_in").alias("asks_in"))
    running = Window.partitionBy(*chunk).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return at.select(*chunk, "pos", *[F.sum(f"{s}_in").over(running).alias(f"{s}_in") for s in ("bids", "asks")])


def tops(found: Chain, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(generation, pos, kind, made_bids, made_asks, bids_in, asks_in): the best levels after each update (one of each side) and at each recorded
    book (as many as it has), and how many are left in the snapshot's range."""
    rows = running_sum(found.rows, F.lit(1), "row", GENERATION, "pos", PLACES << 20)
    rows = shared_table(rows.withColumn("chunk", F.expr(f"(row - 1) div {chunk_rows}")), "book-chunks")
    levels, chunks = _intervals(rows)
    levels = shared_table(levels, "book-levels")
    wanted = F.when(F.col("kind") == "trusted", F.greatest(F.size(_levels("bids")), F.size(_levels("asks")))).otherwise(1)
    asked = rows.where("kind <> 'bootstrap'").select(*GENERATION, "chunk", "pos", "kind", wanted.alias("n"))
    near = _near(levels, chunks)
    valid = (F.col("since") <= F.col("pos")) & (F.col("until").isNull() | (F.col("pos") < F.col("until")))
    met = near.alias("l").join(asked.alias("a"), [*GENERATION, "chunk"]).where(valid)
    entry = F.struct("o", "price", "quantity")
    best = met.groupBy(*GENERATION, "chunk", "pos").agg(*[F.sort_array(F.collect_list(F.when(F.col("side") == s, entry))).alias(f"{s}s") for s in ("bid", "ask")])
    none = F.array().cast("array<struct<o:decimal(18,8),price:decimal(18,8),quantity:decimal(18,8)>>")
    cut = lambda s: F.transform(F.slice(F.coalesce(F.col(s), none), F.lit(1), F.col("n")), lambda x: F.struct(x["price"].alias("price"), x["quantity"].alias("quantity")))
    out = asked.join(best, [*GENERATION, "chunk", "pos"], "left").join(_covered(levels, asked, found.snapshots), [*GENERATION, "chunk", "pos"], "left")
    return out.select(*GENERATION, "pos", "kind", cut("bids").alias("made_bids"), cut("asks").alias("made_asks"), "bids_in", "asks_in")


def _broken_updates(states: DataFrame, snapshots: DataFrame) -> DataFrame:
    """(generation, pos, reason, gap): the first update of each generation after which its book isn't valid."""
    bid, ask = F.get("made_bids", F.lit(0))["price"], F.get("made_asks", F.lit(0))["price"]
    why = (
        F.when(bid.isNull() | ask.isNull(), "empty side").when(bid >= ask, "crossed")
        .when(F.col("low").isNotNull() & (F.col("bids_in") < COVER_LEVELS), "bids left the snapshot's range")
        .when(F.col("high").isNotNull() & (F.col("asks_in") < COVER_LEVELS), "asks left the snapshot's range")
    )
    bad = states.where("kind = 'depth'").join(snapshots, GENERATION).withColumn("why", why).where("why is not null")
    return bad.groupBy(*GENERATION).agg(F.min("pos").alias("pos"), F.concat(F.lit("invalid depth: "), F.min_by("why", "pos")).alias("reason"), F.lit(False).alias("gap"))


@dataclass
class Rebuilt:
    """``books``: a row for each recorded book: keys, capture_seq, reason (null, or why there is no book), made_id,
    made_bids, made_asks, gaps (sequence gaps so far in the series); ``faults``: the first fault of each generation:
    keys, capture_seq, reason, and whether the stream itself is at fault (``fatal``: a bootstrap that isn't a book, a missing buffered update)."""

    books: DataFrame
    faults: DataFrame


def rebuild(events: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Rebuilt:
    """Books of a tagged event stream at each of its recorded books.

    ``events``: keys, capture_seq (no ties in a series), kind (lifecycle, depth, bootstrap, trusted), first_id, final_id, previous_id, bids, asks (arrays of
    (price, quantity)), snapshot_limit, buffered_ids.  A recorded book has as many levels rebuilt as it has itself.
    """
    marked = _marked(events)
    found = chain(marked)
    states = shared_table(tops(found, chunk_rows), "book-states")
    late = _broken_updates(states, found.snapshots)
    every = shared_table(found.faults.unionByName(late), "book-all-faults")
    first = every.groupBy(*GENERATION).agg(F.min("pos").alias("fault"), F.min_by("reason", "pos").alias("fault_reason"), F.min_by("gap", "pos").alias("gap"))
    trusted = marked.where("kind = 'trusted'").select(*GENERATION, "capture_seq", (F.col("capture_seq") * PLACES).alias("pos"))
    ids = found.rows.where("kind = 'trusted'").select(*GENERATION, "pos", "made_id")
    out = trusted.join(found.snapshots.select(*GENERATION, "anchor", "reach"), GENERATION, "left").join(first, GENERATION, "left")
    out = out.join(states.where("kind = 'trusted'").select(*GENERATION, "pos", "made_bids", "made_asks"), [*GENERATION, "pos"], "left").join(ids, [*GENERATION, "pos"], "left")
    reason = F.when(F.col("anchor").isNull(), NO_BOOK).when(F.col("fault") < F.col("pos"), F.col("fault_reason")).when(F.col("reach").isNull() | (F.col("pos") < F.col("reach")), "not bridged")
    out = out.withColumn("reason", reason)
    made = [F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in ("made_id", "made_bids", "made_asks")]
    gaps = first.where("gap").select(*KEYS, F.expr(f"fault div {PLACES}").alias("gap_seq"))
    counted = running_sum(marked.select(*KEYS, "capture_seq", "kind").join(gaps.withColumnRenamed("gap_seq", "capture_seq").withColumn("gap", F.lit(1)), [*KEYS, "capture_seq"], "left"), F.coalesce("gap", F.lit(0)), "gaps")
    out = out.select(*KEYS, "capture_seq", "reason", *made).join(counted.where("kind = 'trusted'").select(*KEYS, "capture_seq", "gaps"), [*KEYS, "capture_seq"])
    fatal = F.col("fault_reason").startswith("invalid bootstrap") | F.col("fault_reason").startswith("missing")
    return Rebuilt(out, first.select(*KEYS, F.expr(f"fault div {PLACES}").alias("capture_seq"), F.col("fault_reason").alias("reason"), fatal.alias("fatal")))
