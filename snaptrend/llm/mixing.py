"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snaptrend.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that share one running sum, slots that share one ranking.
SUM_ROWS = 2_000
RANK_BITS = 16


def sizes(docs: DataFrame) -> DataFrame:
    """Words of every row, with the key that shuffles it: sixty bits of a hash of its id."""
    mark = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.conv(F.substring(mark, 1, 15), 16, 10).cast("bigint").alias("_key"),
    )


def targets(sized: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), percent: int = 150, cap: int = 2) -> DataFrame:
    """Target of every source: one small row each.

    Sources in order of code points (null last) weigh ``cycle``, repeating, and share ``percent`` of all
    words; none gets more than ``cap`` times its own, the excess goes to the others by weight. In order
    of size by weight the sources that reach their cap come first, so running sums settle it.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_sid", F.row_number().over(order) - 1)
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, cycle)), F.col("_sid") % len(cycle) + 1).cast("bigint"))
        .withColumn("_ratio", F.col("source_size") / F.col("_weight"))
    )
    climb = Window.orderBy("_ratio", "_sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Hundredths of a word keep the sums in whole numbers.
    rows = (
        rows.withColumn("_pos", F.count(F.lit(1)).over(climb))
        .withColumn("_cap", F.col("source_size") * (100 * cap))
        .withColumn("_rest", F.sum("source_size").over(everything) * percent - F.sum("_cap").over(climb) + F.col("_cap"))
        .withColumn("_left", F.sum("_weight").over(everything) - F.sum("_weight").over(climb) + F.col("_weight"))
        .withColumn("_full", F.col("_cap") / F.col("_weight") <= F.col("_rest") / F.col("_left"))
        .withColumn("_open", F.min(F.when(~F.col("_full"), F.struct("_pos", "_rest", "_left"))).over(everything))
    )
    capped = F.col("_full") | F.col("_open").isNull()
    share = (F.col("_weight") * F.col("_open._rest")) / (F.col("_open._left") * 100)
    return rows.select(
        "_sid", "source", "source_size", "_rows",
        F.when(capped, (F.col("source_size") * cap).cast("double")).otherwise(share).alias("target"),
    ).withColumn("_quota", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * cap))


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """Slots of the mix: slot, source and rank of the slot within its source.

    Slot ``i`` of ``2^m`` has the van der Corput point of ``i`` (its bits reversed), which falls into
    one source's stretch of the cumulated quotas. The points of a stretch are whole numbers in a row, so
    each source lists its own and no join is needed. ``2^m`` is at least twice the blocks wanted, which gives
    every source its last block; slots beyond it are let go.
    """
    wanted = plan.withColumn("_blocks", F.ceil(F.col("_quota") / block))
    total = wanted.agg(F.sum("_blocks")).first()[0] or 0
    bits = max(1, (2 * total - 1).bit_length())
    slots = 1 << bits
    upto = F.sum("_blocks").over(Window.orderBy("_sid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = lambda c: F.least(F.ceil(c * (slots / max(total, 1))), F.lit(slots))
    run = 1 << RANK_BITS
    stretches = (
        wanted.withColumn("_to", upto)
        .where("_blocks > 0")
        .select("_sid", "_blocks", edge(F.col("_to") - F.col("_blocks")).alias("_lo"), edge(F.col("_to")).alias("_hi"))
        .select("_sid", "_blocks", "_hi", F.explode(F.sequence("_lo", F.col("_hi") - 1, F.lit(run))).alias("_lo"))
    )
    points = stretches.repartition("_sid", "_lo").select(
        "_sid", "_blocks", F.explode(F.sequence("_lo", F.least(F.col("_lo") + run, F.col("_hi")) - 1)).alias("_v")
    )
    slot = F.conv(F.reverse(F.lpad(F.bin("_v"), bits, "0")), 2, 10).cast("bigint")
    points = points.select("_sid", "_blocks", slot.alias("slot")).withColumn(
        "_part", F.shiftright("slot", RANK_BITS)
    )
    before = Window.partitionBy("_sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = points.groupBy("_sid", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_sid", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    ranked = points.withColumn("_rn", F.row_number().over(Window.partitionBy("_sid", "_part").orderBy("slot")))
    return (
        ranked.join(parts, ["_sid", "_part"])
        .select("_sid", "slot", "_blocks", (F.col("_before") + F.col("_rn")).alias("rank"))
        .where("rank <= _blocks")
        .select("_sid", "slot", "rank")
    )


def positions(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """First word of every document in the shuffled stream of its source.

    The stream follows the hash, cut by its leading bits so that no running sum takes in a whole source.
    """
    bits = F.ceil(F.log2(F.greatest(F.col("_rows") / SUM_ROWS, F.lit(1.0)))).cast("int")
    rows = (
        sized.where("size > 0")
        .join(plan.select("_sid", "source", "source_size", "_rows", "_quota"), sized["source"].eqNullSafe(plan["source"]))
        .select("_sid", "doc_id", "size", "_key", "_quota", "source_size", bits.alias("_bits"))
        .withColumn("_part", F.expr("_key div cast(pow(2, 60 - _bits) as bigint)"))
    )
    inside = Window.partitionBy("_sid", "_part").orderBy("_key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("_sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("_sid", "_part").agg(F.sum("size").alias("_n")).select(
        "_sid", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return (
        rows.withColumn("_at", F.sum("size").over(inside) - F.col("size"))
        .join(parts, ["_sid", "_part"])
        .withColumn("_at", F.col("_at") + F.col("_before"))
        .drop("_part", "_before", "_bits")
    )


def blocks(placed: DataFrame, block: int, cap: int) -> DataFrame:
    """Pieces of documents in the equal blocks of their source's stream, run through ``cap`` times."""
    rows = placed.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
    rows = rows.withColumn("_from", F.col("_epoch") * F.col("source_size") + F.col("_at")).where("_from < _quota")
    rows = rows.withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_quota")))
    first, last = F.expr(f"_from div {block}"), F.expr(f"(_to - 1) div {block}")
    rows = rows.withColumn("_block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("_from"), F.col("_block") * block)
    end = F.least(F.col("_to"), (F.col("_block") + 1) * block)
    return rows.select(
        "_sid", "_block", "doc_id", "size", "_at", (start - F.col("_from")).alias("first_word"),
        (end - start).alias("n_words"),
    )


def mixed_pieces(docs: DataFrame, cycle=(5, 2, 1), percent=150, cap=2, block=1024) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix itself: pieces of documents with their slot; also sizes and targets, stored once."""
    sized = checkpointed(sizes(docs))
    plan = checkpointed(targets(sized, cycle, percent, cap))
    slots = schedule(plan, block).withColumn("_block", F.col("rank") - 1)
    pieces = blocks(positions(sized, plan), block, cap).join(slots, ["_sid", "_block"])
    return pieces, sized, plan


def mix(docs: DataFrame, cycle=(5, 2, 1), percent=150, cap=2, block=1024) -> DataFrame:
    """Words that the mix takes of every document: doc_id, size, source, source_size, target, taken.

    One row comes out for each that goes in. A null text has no words; a null source is a source of its own.
    Without words every target is 0. Rows that share an id keep their own row and take their own
    words; equal rows are interchangeable. Other columns are ignored. Runs agree, as all orders are by hash.
    """
    pieces, sized, plan = mixed_pieces(docs, cycle, percent, cap, block)
    took = pieces.groupBy("_sid", "_at", "doc_id", "size").agg(F.sum("n_words").alias("taken"))
    named = plan.select("_sid", "source", "source_size", "target")
    # A document's place in its stream tells rows of one id apart; those without words take no part.
    placed = positions(sized, plan).select("_sid", "_at", "doc_id", "size")
    rows = placed.join(
        took.select(F.col("_sid").alias("_s"), F.col("_at").alias("_a"), "taken"),
        (F.col("_sid") == F.col("_s")) & (F.col("_at") == F.col("_a")), "left",
    ).select("_sid", "doc_id", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    full = rows.join(named, "_sid").select("doc_id", "size", "source", "source_size", "target", "taken")
    none = (
        sized.where("size = 0").withColumnRenamed("source", "_source")
        .join(named, F.col("_source").eqNullSafe(F.col("source")))
        .select("doc_id", "size", "source", "source_size", "target", F.lit(0).cast("bigint").alias("taken"))
    )
    return full.unionByName(none)


QUERY = "op9_mix_sources"


def query(spark, folder) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: Every block up to a source's quota is taken, so a document takes what of its stream lies below it.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15) AS k FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source
), w AS (SELECT *, [5, 2, 1][(sid % 3 + 1)::INT]::BIGINT AS wt FROM s
), c AS (
  SELECT *, 3 * sum(ss) OVER () - 4 * (sum(ss) OVER (ORDER BY ss / wt, sid ROWS UNBOUNDED PRECEDING) - ss) AS rest,
         2 * (sum(wt) OVER () - sum(wt) OVER (ORDER BY ss / wt, sid ROWS UNBOUNDED PRECEDING) + wt) AS lft,
         row_number() OVER (ORDER BY ss / wt, sid) AS pos FROM w
), f AS (SELECT *, 2 * ss * lft <= wt * rest AS is_full FROM c
), o AS (SELECT arg_min(rest, pos) AS r, arg_min(lft, pos) AS l FROM f WHERE NOT is_full
), t AS (
  SELECT f.source, ss, CASE WHEN is_full OR o.r IS NULL THEN (2 * ss)::DOUBLE
         ELSE (wt * o.r * 50)::DOUBLE / (o.l * 50)::DOUBLE END AS target FROM f, o
), q AS (SELECT *, least(floor(target + 0.5)::BIGINT, 2 * ss) AS quota FROM t
), p AS (
  SELECT d.doc_id, d.size, q.ss, q.target, q.quota,
         sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS a
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, ss AS source_size, target,
       (greatest(0, least(a + size, quota) - a) + greatest(0, least(ss + a + size, quota) - ss - a))::BIGINT AS taken FROM p
"""
