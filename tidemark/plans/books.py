"""Queries of rebuilt order books over a book stream made from the event table, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import book, rebuild, series
from tidemark.session import shared_table
from tidemark.sources import projections
from tidemark.sources.projections import KEYS

from .oracle import OBS, with_

_LEVELS = "array<struct<price:decimal(18,8),quantity:decimal(18,8)>>"


def _level(price: Column, quantity: Column) -> Column:
    return F.struct(price.cast("decimal(18,8)").alias("price"), quantity.cast("decimal(18,8)").alias("quantity"))


def book_stream(spark: SparkSession, d: str) -> DataFrame:
    """Trades as depth updates of one level a side, rare errors as bootstraps and lifecycle rows, the rest as recorded books
    of three levels.  Some updates break the chain of ids, some cross the book, many take levels away."""
    obs = projections.observations(spark, d)
    error, k, seq = F.col("event_type") == "error", F.col("k"), F.col("capture_seq")
    kind = F.when(error & (k < 2), "lifecycle").when(error & (k >= 98), "bootstrap").when(F.col("event_type").isin("click", "view"), "depth").when(~error, "trusted")
    rows = obs.select(*KEYS, "capture_seq", "k", kind.alias("kind")).where("kind is not null")
    rows = series.last_before(rows, F.when(F.col("kind") == "depth", seq), "prev_u")
    depth, boot, named = F.col("kind") == "depth", F.col("kind") == "bootstrap", F.col("prev_u").isNotNull() & (k == 98)
    ladder = lambda base, sign: F.transform(F.sequence(F.lit(0), F.lit(14)), lambda i: _level(F.lit(base) + i * sign, i % 3 + 1))
    bid = F.array(_level(999 - k % 15, F.when(k % 4 == 0, 0).otherwise(seq % 9 + 1)))
    ask = F.array(_level(F.when(k == 33, 990).otherwise(1001 + seq % 15), F.when(k % 7 == 0, 0).otherwise(seq % 5 + 1)))
    some = F.array_repeat(_level(F.lit(1), F.lit(1)), 3)
    return rows.select(
        *KEYS,
        "capture_seq",
        "kind",
        F.when(depth, F.coalesce(F.col("prev_u") + 1, seq)).alias("first_id"),
        F.when(depth, seq).when(boot, F.when(named, F.col("prev_u")).otherwise(seq)).otherwise(F.col("prev_u")).alias("final_id"),
        F.when(depth, F.col("prev_u") + F.when(k == 55, 1).otherwise(0)).alias("previous_id"),
        F.when(depth, bid).when(boot, ladder(999, -1)).when(F.col("kind") == "trusted", some).cast(_LEVELS).alias("bids"),
        F.when(depth, ask).when(boot, ladder(1001, 1)).when(F.col("kind") == "trusted", some).cast(_LEVELS).alias("asks"),
        F.when(boot, F.when(k == 98, 15).otherwise(1000)).alias("snapshot_limit"),
        F.when(boot, F.when(named, F.array("prev_u")).otherwise(F.array().cast("array<bigint>"))).alias("buffered_ids"),
    )


def books_at_instants(spark: SparkSession, d: str) -> DataFrame:
    """The three best levels of each side at each recorded book, or why there is no book."""
    made = rebuild.rebuild(book_stream(spark, d)).books
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("x", x["price"].cast("bigint").cast("string"), x["quantity"].cast("bigint").cast("string"))), " ")
    return made.select(*KEYS, "capture_seq", "reason", "made_id", text("made_bids").alias("bids"), text("made_asks").alias("asks"), "gaps")


def reconstruct_compare(spark: SparkSession, d: str) -> DataFrame:
    """Rebuilt against recorded books, some of which are off in a level, in the update id or in the best quantity."""
    stream = shared_table(book_stream(spark, d), "book-stream")
    made = shared_table(rebuild.rebuild(stream).books, "book-made")
    off = lambda n: F.when(F.col("capture_seq") % n == 0, 1).otherwise(0)
    bids = F.transform("made_bids", lambda x, i: _level(x["price"], x["quantity"] + F.when(i == 0, off(7)).otherwise(0)))
    recorded = made.where("reason is null").select(*KEYS, "capture_seq", bids.cast(_LEVELS).alias("r_bids"), "made_asks", (F.col("made_id") - off(11)).alias("r_id"), (F.get("made_bids", F.lit(0))["quantity"] + off(13)).alias("best_bid_quantity"))
    rows = stream.where("kind = 'trusted'").join(recorded, [*KEYS, "capture_seq"], "left")
    rows = rows.withColumns({"bids": F.coalesce("r_bids", "bids"), "asks": F.coalesce("made_asks", "asks"), "final_id": F.coalesce("r_id", "final_id")})
    # what recorded books hold never moves the rebuilt ones, only how many levels are asked for, and here none are that the book doesn't have
    return book.compare(rows.drop("r_bids", "made_asks", "r_id"), made)


def reconstruction_faults(spark: SparkSession, d: str) -> DataFrame:
    """Where each generation's book ends, and why."""
    return book.reconstruction_faults(book_stream(spark, d))


_STREAM = """kinds AS (
  SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN k < 2 THEN 'lifecycle' WHEN k >= 98 THEN 'bootstrap' END WHEN event_type IN ('click', 'view') THEN 'depth' ELSE 'trusted' END AS kind FROM obs
), marked AS MATERIALIZED (
  SELECT capture_session_id, symbol, capture_seq, k, kind, max(CASE WHEN kind = 'depth' THEN capture_seq END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_u,
         count(CASE WHEN kind IN ('bootstrap', 'lifecycle') THEN 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS generation, count(CASE WHEN kind = 'lifecycle' THEN 1 END) OVER (w ROWS UNBOUNDED PRECEDING) AS connection
  FROM kinds WHERE kind IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY capture_seq)
), boots AS (
  SELECT symbol, generation, connection, capture_seq, prev_u, k = 98 AND prev_u IS NOT NULL AS named, CASE WHEN k = 98 THEN coalesce(prev_u, capture_seq) ELSE capture_seq END AS anchor, k = 98 AS limited FROM marked WHERE kind = 'bootstrap'
), depth AS (
  SELECT symbol, generation, connection, capture_seq, capture_seq AS final_id, coalesce(prev_u + 1, capture_seq) AS first_id, prev_u + CASE WHEN k = 55 THEN 1 ELSE 0 END AS previous_id, k FROM marked WHERE kind = 'depth'
), placed AS (
  SELECT d.symbol, d.generation, 2 * d.capture_seq AS pos, 'depth' AS kind, d.final_id, d.first_id, d.previous_id, d.k, d.capture_seq AS seq, b.anchor FROM depth d JOIN boots b USING (symbol, generation)
  UNION ALL SELECT b.symbol, b.generation, 2 * b.capture_seq + 1, CASE WHEN d.final_id IS NULL THEN 'missing' ELSE 'depth' END, b.prev_u, d.first_id, d.previous_id, d.k, d.capture_seq, b.anchor
    FROM boots b LEFT JOIN depth d ON d.symbol = b.symbol AND d.connection = b.connection AND d.final_id = b.prev_u WHERE b.named
  UNION ALL SELECT m.symbol, m.generation, 2 * m.capture_seq, 'trusted', NULL, NULL, NULL, NULL, m.capture_seq, b.anchor FROM marked m JOIN boots b USING (symbol, generation) WHERE m.kind = 'trusted'
), reached AS (SELECT *, min(CASE WHEN kind = 'depth' AND final_id >= anchor THEN pos END) OVER (PARTITION BY symbol, generation) AS reach FROM placed),
chained AS (SELECT *, max(CASE WHEN kind = 'depth' AND pos >= reach THEN final_id END) OVER (PARTITION BY symbol, generation ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS made_id FROM reached),
applied AS (SELECT *, kind = 'depth' AND coalesce(pos >= reach, false) AND NOT coalesce(pos > reach AND final_id = made_id, false) AS applies FROM chained),
judged AS MATERIALIZED (
  SELECT *, applies AND NOT coalesce(CASE WHEN pos > reach THEN previous_id = made_id ELSE first_id <= anchor AND final_id >= anchor END, false) AS wrong FROM applied
), changes AS MATERIALIZED (
  SELECT b.symbol, b.generation, 2 * b.capture_seq AS pos, s.side, CASE WHEN s.side = 'bid' THEN 999 - i.i ELSE 1001 + i.i END AS price, i.i % 3 + 1 AS q FROM boots b, (VALUES ('bid'), ('ask')) s(side), range(15) i(i)
  UNION ALL SELECT symbol, generation, pos, 'bid', 999 - k % 15, CASE WHEN k % 4 = 0 THEN 0 ELSE seq % 9 + 1 END FROM judged WHERE applies
  UNION ALL SELECT symbol, generation, pos, 'ask', CASE WHEN k = 33 THEN 990 ELSE 1001 + seq % 15 END, CASE WHEN k % 7 = 0 THEN 0 ELSE seq % 5 + 1 END FROM judged WHERE applies
), alive AS MATERIALIZED (
  SELECT a.symbol, a.generation, a.pos, c.side, c.price, arg_max(c.q, c.pos) AS q FROM judged a JOIN changes c ON c.symbol = a.symbol AND c.generation = a.generation AND c.pos <= a.pos
  WHERE a.applies OR a.kind = 'trusted' GROUP BY ALL HAVING arg_max(c.q, c.pos) > 0
), best AS (
  SELECT symbol, generation, pos, max(CASE WHEN side = 'bid' THEN price END) AS b, min(CASE WHEN side = 'ask' THEN price END) AS a, count(CASE WHEN side = 'bid' AND price >= 985 THEN 1 END) AS bids_in, count(CASE WHEN side = 'ask' AND price <= 1015 THEN 1 END) AS asks_in FROM alive GROUP BY ALL
), bad AS (
  SELECT j.symbol, j.generation, j.pos, false AS gap, 'invalid depth: ' || CASE WHEN e.b IS NULL OR e.a IS NULL THEN 'empty side' WHEN e.b >= e.a THEN 'crossed' WHEN o.limited AND e.bids_in < 10 THEN 'bids left the snapshot''s range' WHEN o.limited AND e.asks_in < 10 THEN 'asks left the snapshot''s range' END AS reason
  FROM judged j JOIN boots o USING (symbol, generation) LEFT JOIN best e USING (symbol, generation, pos) WHERE j.applies
  UNION ALL SELECT symbol, generation, pos, wrong AND pos > reach, CASE WHEN kind = 'missing' THEN 'missing buffered depth event ' || final_id WHEN wrong THEN 'no synchronized book' END FROM judged WHERE kind = 'missing' OR wrong
), faults AS MATERIALIZED (
  SELECT symbol, generation, min(pos) AS pos, arg_min(reason, pos) AS reason, arg_min(gap, pos) AS gap FROM (SELECT symbol, generation, pos, max(reason) AS reason, bool_or(gap) AS gap FROM (SELECT * FROM bad WHERE reason IS NOT NULL AND reason NOT LIKE 'invalid%' UNION ALL
    SELECT b.* FROM bad b WHERE b.reason LIKE 'invalid%' AND NOT EXISTS (SELECT 1 FROM judged j WHERE j.symbol = b.symbol AND j.generation = b.generation AND j.pos = b.pos AND j.wrong)) GROUP BY ALL) GROUP BY symbol, generation
), tops AS (
  SELECT symbol, generation, pos, string_agg(CASE WHEN side = 'bid' THEN price || 'x' || q END, ' ' ORDER BY price DESC) AS bids, string_agg(CASE WHEN side = 'ask' THEN price || 'x' || q END, ' ' ORDER BY price) AS asks FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, generation, pos, side ORDER BY CASE WHEN side = 'bid' THEN -price ELSE price END) AS rn FROM alive) WHERE rn <= 3 GROUP BY symbol, generation, pos
), books AS MATERIALIZED (
  SELECT m.capture_session_id, m.symbol, m.capture_seq, CASE WHEN o.anchor IS NULL THEN 'no synchronized book' WHEN f.pos < 2 * m.capture_seq THEN f.reason WHEN j.reach IS NULL OR j.pos < j.reach THEN 'not bridged' END AS reason, j.made_id, t.bids, t.asks,
         (SELECT count(*) FROM faults g WHERE g.symbol = m.symbol AND g.gap AND g.pos // 2 <= m.capture_seq) AS gaps
  FROM (SELECT *, 2 * capture_seq AS pos FROM marked WHERE kind = 'trusted') m LEFT JOIN boots o USING (symbol, generation) LEFT JOIN faults f USING (symbol, generation) LEFT JOIN judged j ON j.symbol = m.symbol AND j.generation = m.generation AND j.pos = m.pos
    LEFT JOIN tops t ON t.symbol = m.symbol AND t.generation = m.generation AND t.pos = m.pos
)"""

QUERIES = {"books_at_instants": books_at_instants, "reconstruct_compare": reconstruct_compare, "reconstruction_faults": reconstruction_faults}
SQL = {
    "books_at_instants": f"""{with_(OBS, _STREAM)} SELECT capture_session_id, symbol, capture_seq, reason, CASE WHEN reason IS NULL THEN made_id END AS made_id, CASE WHEN reason IS NULL THEN bids END AS bids, CASE WHEN reason IS NULL THEN asks END AS asks, gaps FROM books""",
    "reconstruct_compare": f"""{with_(OBS, _STREAM)}, compared AS (SELECT *, coalesce(reason, nullif(concat_ws(', ', CASE WHEN capture_seq % 11 = 0 THEN 'last_update_id' END, CASE WHEN capture_seq % 7 = 0 THEN 'bids' END, CASE WHEN capture_seq % 13 = 0 THEN 'best_bid_quantity' END), '')) AS error FROM books)
        SELECT capture_session_id, symbol, capture_seq, error IS NULL AS ok, error, gaps FROM compared""",
    "reconstruction_faults": f"""{with_(OBS, _STREAM)} SELECT 'S0' AS capture_session_id, symbol, pos // 2 AS capture_seq, reason, reason LIKE 'missing%' AS fatal FROM faults""",
}
