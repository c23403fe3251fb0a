"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.llm.common import hex_digits, sliced_rank
from topicloom.session import materialize

WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
SEED = 17


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null text has none."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, "[\\x20\\x09-\\x0D]+"))).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], total_share: float, most_copies: float) -> DataFrame:
    """``source, source_size`` -> also ``target``; one row per source.

    Sources by code point (null last) take the weights in turn and share ``total_share`` of all words; a target stops
    at ``most_copies`` times its source, and what is left is shared again by weight. Sources reach their limit in the
    order of limit by weight, so one ordered pass finds the level at which the rest stays below theirs.
    """
    everyone = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(everyone) - 1) % len(weights) + 1).cast("int"))
    listed = sizes.withColumn("__w", turn).withColumn("__limit", F.col("source_size") * F.lit(float(most_copies)))
    by_limit = Window.orderBy(F.col("__limit") / F.col("__w"), F.col("source").asc_nulls_last())
    done, rest = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(total_share))
    level = (total - F.coalesce(F.sum("__limit").over(done), F.lit(0.0))) / F.sum("__w").over(rest)
    levelled = listed.withColumn("__level", level)
    free = F.when(F.col("__limit") > F.col("__level") * F.col("__w"), F.col("__level"))
    # Past the first source below its limit every other one is below too, at that same level.
    ordered = levelled.withColumn("__first", F.first(free, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return ordered.select("source", "source_size", F.when(F.col("__first").isNull(), F.col("__limit")).otherwise(F.col("__first") * F.col("__w")).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most_copies: float = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, copies, taken: one row per row of ``docs``.

    Within a source every document expects target / source_size copies. The prefix sums of these, shifted by one
    random offset per source, cross integers; a document is emitted once per integer crossed in its own stretch.
    Documents are lined up by size class (four leading bits), then by the md5 of their id, so that every size is
    sampled evenly and the words taken stay within about one long document of the target. Positions come from counts
    of slices; a hot source is never sorted as a whole. Null sources form one source, null or blank texts have size 0
    and count as documents, null ids are ordered as one id, repeated rows are separate rows, an empty table gives no
    rows; other columns are ignored.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    sized = materialize(sized, "mix-sizes")
    bits = F.length(F.bin("size"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    keyed = sized.withColumns({"__bits": bits, "__lead": F.expr("shiftright(size, greatest(length(bin(size)) - 4, 0))"), "__key": key})
    ranked = sliced_rank(keyed, ["source"], ["__bits", "__lead"], "__key", [F.col("doc_id"), F.col("size"), F.col("text_hash")], hex_digits(sized.count()), "__rank")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))).cast("binary")), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)
    rates = source_targets(totals, weights, total_share, most_copies).withColumns(
        {"__rate": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)), "__offset": offset}
    )
    joined = ranked.alias("r").join(rates.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    crossed = F.floor(F.col("__rate") * (F.col("__rank") + 1) + F.col("__offset")) - F.floor(F.col("__rate") * F.col("__rank") + F.col("__offset"))
    return joined.select("doc_id", F.col("r.source").alias("source"), "text_hash", "size", "source_size", "target", crossed.cast("int").alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))



def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, total_share: float = TOTAL_SHARE, most_copies: float = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns."""
    taken = mix_sources(docs, weights, total_share, most_copies, seed).groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    taken = taken.where("__copies > 0").alias("t")
    rows = docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit("")))).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.__hash") == F.col("t.text_hash"))
    met = rows.join(taken, same).select("d.*", "__copies", "__rows")
    # Rows with equal id, source and text cannot be told apart: one of them stands for all their copies.
    again = met.where("__rows > 1").dropDuplicates(["doc_id", "source", "__hash"])
    every = met.where("__rows = 1").unionByName(again)
    return every.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


MIX_SQL = f"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([{', '.join(str(x) for x in WEIGHTS)}]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * {MOST_COPIES}::DOUBLE AS lim FROM s),
l AS (SELECT *, (sum(source_size) OVER () * {TOTAL_SHARE}::DOUBLE
   - coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT *, first_value(CASE WHEN lim > level * w THEN level END IGNORE NULLS) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level1 FROM l),
t AS (SELECT *, CASE WHEN level1 IS NULL THEN lim ELSE level1 * w END AS target,
  ('0x' || substr(md5('{SEED}/' || coalesce('s' || source, 'null')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u FROM f),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY length(bin(size)), size >> greatest(length(bin(size)) - 4, 0), md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), doc_id, size) - 1 AS k FROM d),
c AS (SELECT r.*, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate * (k + 1) + u) - floor(rate * k + u))::BIGINT * size)::BIGINT AS taken FROM c"""
