"""Chat formatting: conversations that begin alike share their first turns in a prefix tree, emitted once depth first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicloom.llm.packing import load_encoder, vocabulary_path
from topicloom.session import materialize

# The template of a turn. A backslash in a text is doubled, and the two characters that begin every mark are parted
# by one, so no text can hold a mark.
OPEN, BODY, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"
# Stands for a null conversation id inside the operator.
NULL_ID = -(2**63)

_TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(CLOSE), re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn, read back from formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Token ids of the turns of each branch, where turns end, and which tokens are learned."""
    encoder = load_encoder(path, {})
    close = encoder.encode_ordinary(CLOSE)
    heads: dict[str, list[int]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids: list[int] = []
            ends, loss = [], []
            for turn in sorted(row["turns"], key=lambda t: t["depth"]):
                role = turn["role"]
                if role not in heads:
                    if len(heads) > 1000:
                        heads.clear()
                    heads[role] = encoder.encode_ordinary(OPEN + escape(role) + BODY)
                ids += heads[role]
                start = len(ids)
                ids += encoder.encode_ordinary(escape(turn["text"]))
                if role == LEARNED_ROLE and len(ids) > start:
                    loss.append({"from": start, "to": len(ids)})
                ids += close
                ends.append(len(ids))
            yield pa.RecordBatch.from_pylist(
                [{"branch": row["branch"], "first_depth": min(t["depth"] for t in row["turns"]), "token_ids": ids, "turn_ends": ends, "loss": loss}],
                schema=pa.schema([("branch", pa.int64()), ("first_depth", pa.int32()), ("token_ids", pa.list_(pa.int32())), ("turn_ends", pa.list_(pa.int32())), ("loss", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))]),
            )


_BRANCH = "branch long, first_depth int, token_ids array<int>, turn_ends array<int>, loss array<struct<from int, to int>>"


def format_conversations(turns: DataFrame, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The prefix tree as two tables.

    ``branches``: branch, tree, token_ids, loss (stretches of learned tokens: the texts of assistant turns), position_ids,
    stream_start (where the branch begins in the depth-first stream of all trees) and ancestors: (branch, upto, from,
    to), the tokens of earlier branches that this one attends to; from and to are places in the stream.
    ``conversations``: conv_id, n_turns, parts: (branch, upto), the tokens that make up the conversation in order.

    Conversations are lined up by the hashes of their turns, so those that begin alike stand together and the first to
    hold a turn owns it: its own turns are one branch, and the order of owners is the depth-first order. Turns are in
    the order of turn (null first), role and text; repeated rows are further turns; null roles and texts count as empty;
    rows with a null conv_id form one conversation; an empty table gives empty tables; other columns are ignored.
    """
    ranks = path or vocabulary_path()
    empty = F.lit("")
    rows = turns.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    lined = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("depth", F.row_number().over(lined).cast("int"))
    rows = rows.withColumns({"h": F.xxhash64("depth", "role", "text"), "g": F.xxhash64("text", "role", "depth")})
    # The hashes name the depth too, so a running exclusive or names the whole beginning.
    so_far = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = materialize(rows.withColumns({"key": F.bit_xor("h").over(so_far), "key2": F.bit_xor("g").over(so_far)}), "chat-turns")

    whole = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "h"))).alias("turns"), F.count(F.lit(1)).alias("n_turns"))
    ordered = whole.withColumn("line", F.transform("turns", lambda t: t["h"])).orderBy("line", "conv").select("conv", "n_turns")
    convs = materialize(ordered.withColumn("place", F.monotonically_increasing_id()), "chat-order")

    placed = rows.join(convs.select("conv", "place"), "conv")
    owners = materialize(placed.groupBy("key", "key2").agg(F.min("place").alias("branch")), "chat-owners")
    steps = materialize(placed.join(owners, ["key", "key2"]).select("conv", "place", "depth", "branch", "key", F.when(F.col("branch") == F.col("place"), F.struct("role", "text")).alias("own")), "chat-steps")
    own = steps.where("own IS NOT NULL").groupBy("branch").agg(F.collect_list(F.struct("depth", "own.role", "own.text")).alias("turns"))
    encoded = materialize(own.mapInArrow(lambda batches: _encode(batches, ranks), _BRANCH), "chat-branches")

    # Where each branch begins: counted within the partitions of the order first, then over these.
    sizes = encoded.select("branch", F.size("token_ids").cast("long").alias("n"), F.shiftright("branch", 33).alias("slice"))
    before = F.sum("n").over(Window.partitionBy("slice").orderBy("branch").rowsBetween(Window.unboundedPreceding, -1))
    slices = sizes.groupBy("slice").agg(F.sum("n").alias("n"))
    starts = slices.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("slice_start"))
    stream = materialize(sizes.withColumn("before", F.coalesce(before, F.lit(0))).join(starts, "slice").select("branch", (F.col("before") + F.col("slice_start")).alias("stream_start")), "chat-stream")

    used = steps.groupBy("conv", "place", "branch").agg(F.max("depth").alias("last"))
    marks = encoded.join(stream, "branch").select("branch", "stream_start", "first_depth", "turn_ends")
    reached = used.join(marks, "branch").withColumn("upto", F.element_at("turn_ends", F.col("last") - F.col("first_depth") + 1))
    part = F.struct("last", "branch", "upto", "stream_start")
    parts = reached.groupBy("conv", "place").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    parts = materialize(parts, "chat-parts")

    roots = steps.where("depth = 1").select(F.col("place"), F.col("key").alias("tree"))
    earlier = F.filter("parts", lambda p: p["branch"] != F.col("branch"))
    branches = encoded.join(parts.select(F.col("place").alias("branch"), "parts"), "branch").join(stream, "branch").join(roots.select(F.col("place").alias("branch"), "tree"), "branch")
    branches = branches.withColumn("earlier", earlier).withColumn("position_start", F.aggregate("earlier", F.lit(0), lambda a, p: a + p["upto"]))
    branches = branches.select(
        "branch",
        "tree",
        "token_ids",
        "loss",
        F.when(F.size("token_ids") > 0, F.sequence(F.col("position_start"), F.col("position_start") + F.size("token_ids") - 1)).alias("position_ids"),
        "stream_start",
        F.transform("earlier", lambda p: F.struct(p["branch"].alias("branch"), p["upto"].alias("upto"), p["stream_start"].alias("from"), (p["stream_start"] + p["upto"]).alias("to"))).alias("ancestors"),
    )
    conversations = parts.join(convs, ["conv", "place"]).select(
        F.when(F.col("conv") != NULL_ID, F.col("conv")).alias("conv_id"), "n_turns", F.transform("parts", lambda p: F.struct(p["branch"].alias("branch"), p["upto"].alias("upto"))).alias("parts")
    )
    return branches, conversations


def read_back(branches: DataFrame, conversations: DataFrame, path: str | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all from the two tables."""
    ranks = path or vocabulary_path()
    asked = conversations.select("conv_id", F.posexplode("parts").alias("at", "part")).select("conv_id", "at", "part.branch", "part.upto")
    asked, held = materialize(asked, "chat-asked"), materialize(branches.select("branch", "token_ids", "loss"), "chat-held")
    pieces = asked.join(held, "branch").select("conv_id", F.struct("at", F.slice("token_ids", F.lit(1), F.col("upto")).alias("ids"), F.filter("loss", lambda s: s["to"] <= F.col("upto")).alias("loss")).alias("piece"))
    gathered = pieces.groupBy("conv_id").agg(F.collect_list("piece").alias("pieces"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks, {})
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                pieces = sorted(row.column("pieces").to_pylist()[0], key=lambda p: p["at"])
                formatted = b"".join(encoder.decode_bytes(p["ids"]) for p in pieces).decode()
                learned = unescape(b"".join(encoder.decode_bytes(p["ids"][s["from"] : s["to"]]) for p in pieces for s in p["loss"]).decode())
                turns = parse(formatted)
                told = "".join(f"{role}\n{text}\n" for role, text in turns)
                out.append((row.column("conv_id")[0].as_py(), len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return gathered.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -7, whose two turns look like the marks of common templates."""
    spark: SparkSession = turns.sparkSession
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


CHAT_SQL = """WITH all_turns AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, t, r, '\\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS p(t, r)),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM all_turns),
e AS (SELECT *, length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) + 23 AS chars FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
