"""Shards by jump consistent hashing, with DataFrame functions only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import hex_digits, sliced_rank

# Multiplier of the 64-bit generator of the published method, and its modulus.
MULTIPLIER = 2862933555777941757
MODULUS = 18446744073709551616
HALF = 8589934592  # 2^33: the upper 31 bits of the state make one draw


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key: the last jump that still lands below ``shards``.

    Every step draws the next bucket that would take the key over if shards were appended one by one, so a key needs
    no ring table and moves only into new shards. A null key counts as -1.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    number = F.coalesce(key.cast("bigint"), F.lit(-1).cast("bigint")).cast("decimal(38,0)")
    first = F.struct(F.pmod(number, F.lit(Decimal(MODULUS)).cast("decimal(38,0)")).cast("decimal(38,0)").alias("state"), F.lit(-1).cast("bigint").alias("here"), F.lit(0).cast("bigint").alias("jump"))

    def advance(s: Column) -> Column:
        product = s["state"].cast("decimal(20,0)") * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        return F.pmod(product.cast("decimal(38,0)"), F.lit(Decimal(MODULUS)).cast("decimal(38,0)")).cast("decimal(38,0)")

    def step(s: Column, _: Column) -> Column:
        moved = F.struct(advance(s).alias("state"), s["jump"].alias("here"), s["jump"].alias("jump"))
        return F.when(s["jump"] < shards, moved).otherwise(s)

    def land(s: Column) -> Column:
        draw = F.floor(s["state"] / F.lit(HALF).cast("decimal(10,0)")).cast("double") + F.lit(1.0)
        jump = F.floor((s["here"] + 1).cast("double") * (F.lit(2147483648.0) / draw)).cast("bigint")
        return F.when((s["jump"] < shards) & (s["here"] == s["jump"]), F.struct(s["state"].alias("state"), s["here"].alias("here"), jump.alias("jump"))).otherwise(s)

    # A jump goes forward by one shard at least, so this many steps always reach the end.
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), first, lambda s, i: land(step(s, i)))
    return end["here"].cast("int")


def jump_shards(rows: DataFrame, key: str, shards: int) -> DataFrame:
    """Adds ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard`` (with one more shard) to ``rows``.

    Shards depend on key and shard count alone. Slots follow the md5 of the key and come from counts of slices, so no
    shard is ever sorted as a whole. Equal keys share a shard; their slots follow the other columns. Null keys share
    one shard. Columns of ``rows`` with one of the three names are replaced; an empty table gives an empty table.
    """
    kept = rows.drop("shard", "slot", "grown_shard")
    digits = hex_digits(kept.count(), shards)
    placed = kept.withColumns({"shard": jump_shard(F.col(key), shards), "grown_shard": jump_shard(F.col(key), shards + 1), "__key": F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary"))})
    ties = [F.col(c) for c in kept.columns]
    return sliced_rank(placed, ["shard"], [], "__key", ties, digits, "slot").drop("__key")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return jump_shards(sized, "doc_id", shards).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_CRC = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END))"""
SHARD_SQL = f"""WITH RECURSIVE table_of AS (SELECT {_CRC} AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
walk(r, n, state, here, jump) AS (
  SELECT r, n, ((coalesce(doc_id, -1)::HUGEINT + 18446744073709551616) % 18446744073709551616)::HUGEINT, -1::BIGINT, 0::BIGINT
  FROM d, (SELECT unnest([16, 17]) AS n)
  UNION ALL
  SELECT r, n, s, jump, floor((jump + 1)::DOUBLE * (2147483648.0::DOUBLE / ((s >> 33)::DOUBLE + 1)))::BIGINT
  FROM (SELECT r, n, jump, (state * 2862933555777941757 + 1) % 18446744073709551616 AS s FROM walk WHERE jump < n)),
home AS (SELECT r, n, max(here) AS shard FROM walk GROUP BY r, n),
crc AS (SELECT r, doc_id, strlen(text) AS n, hex(encode(text)) AS h FROM d),
summed AS (SELECT r, doc_id, n + 1 AS size, CASE WHEN n = 0 THEN 0 ELSE
  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(n), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) END AS crc FROM crc, table_of)
SELECT s.doc_id, s.size::BIGINT AS size, s.crc::BIGINT AS text_crc32, 'key' AS law, a.shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY a.shard ORDER BY md5(coalesce(s.doc_id::VARCHAR, 'null')), s.doc_id, s.size, s.crc) - 1)::BIGINT AS slot,
  b.shard::INTEGER AS grown_shard
FROM summed s JOIN home a ON a.r = s.r AND a.n = 16 JOIN home b ON b.r = s.r AND b.n = 17"""
