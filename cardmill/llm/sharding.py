"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced together.

Equal texts form a group, which stays together where it can. Each group is a vector (bytes, tokens, rows), in shares of
what one shard should hold; it goes to the shard where the dot product with the residual capacity is highest, large
groups first.

* Heavy groups, those of more than ``HEAVY`` of a shard in any dimension, are at most ``3 * shards / HEAVY`` and are
  packed in one place. A group that fits into one shard stays whole; a larger one is cut into pieces, which are packed
  like groups.
* All other groups are dealt into blocks by hash, and each block is packed on its own, in proportion to what the heavy
  groups left free. A block holds about ``BLOCK_GROUPS`` groups, however much data there is.

The law is ``bytes``: sizes near equal. Null texts count as empty and form one group with empty texts. Rows with equal
keys are documents of their own; equal rows are told apart by an arbitrary number. Slots follow key and checksum.
An empty table gives an empty result; the number of shards must be positive.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardmill.llm.tables import numbered, read, ready
from cardmill.session import materialize

HEAVY = 0.005
SPLIT = 1.0
PIECES = 8  # pieces of a cut group for each shard it could fill; with fewer, sizes and rows can't both be balanced
BLOCK_GROUPS = 20_000
OVERHEAD = 8


def pack(items: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Shard of each item (rows of shares); ``free`` (shards x dimensions) is changed to what is left."""
    shard = np.empty(len(items), dtype=np.int32)
    for i in np.argsort(-items.max(axis=1, initial=0), kind="stable"):
        s = int((free @ items[i]).argmax())
        shard[i] = s
        free[s] -= items[i]
    return shard


def assign(docs: DataFrame, shards: int, key="doc_id", text_column="text") -> DataFrame:
    """key, size, text_crc32, shard, slot for every row."""
    spark = docs.sparkSession
    text = F.coalesce(text_column, F.lit(""))
    described = docs.select(
        F.col(key).alias("id"), F.md5(text).alias("group"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.regexp_count(text, F.lit("\\S+")).cast("long").alias("tokens"),
    )
    rows = materialize(described, "sized")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = materialize(groups, "groups")
    total = groups.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("bytes", "tokens", "rows")]).first()
    if not total.n:
        return rows.select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    share = [max(total[c], 1) / shards for c in ("bytes", "tokens", "rows")]
    largest = F.greatest(*[F.col(c) / s for c, s in zip(("bytes", "tokens", "rows"), share)])

    heavy = groups.filter(largest > HEAVY).orderBy("group").toPandas()  # at most 3 * shards / HEAVY rows
    pieces = []
    for g in heavy.itertuples():
        part = max(g.bytes / share[0], g.tokens / share[1], g.rows / share[2])
        count = min(g.rows, math.ceil(part * PIECES)) if part > SPLIT else 1
        cuts = [g.rows * i // count for i in range(count + 1)]
        pieces += [(g.group, a, b, g.bytes, g.tokens, g.rows, count > 1) for a, b in zip(cuts[:-1], cuts[1:])]
    items = np.array([[p[3] / share[0], p[4] / share[1], p[5] / share[2]] for p in pieces]).reshape(-1, 3)
    items = items * np.array([(p[2] - p[1]) / p[5] for p in pieces]).reshape(-1, 1)
    free = np.ones((shards, 3))
    placed = pack(items, free)
    schema = "group string, low long, high long, shard int, cut boolean"
    placed = spark.createDataFrame([(p[0], p[1], p[2], int(s), p[6]) for p, s in zip(pieces, placed)], schema)

    light_total = np.maximum(free, 0)
    blocks = max(1, math.ceil(total.n / BLOCK_GROUPS))

    def one_block(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("group")
        mine = frame[["bytes", "tokens", "rows"]].to_numpy() / np.array(share)
        room = light_total / np.maximum(light_total.sum(axis=0), 1e-12) * mine.sum(axis=0)
        scale = np.maximum(mine.sum(axis=0) / shards, 1e-12)
        turn = int(frame["block"].iloc[0]) % shards  # no shard is the first choice of every block
        shard = (pack(mine / scale, np.roll(room / scale, -turn, axis=0)) + turn) % shards
        return pd.DataFrame({"group": frame["group"], "shard": shard.astype(np.int32)})

    light = groups.filter(largest <= HEAVY).withColumn("block", F.pmod(F.xxhash64("group"), F.lit(blocks)))
    light = light.groupBy("block").applyInPandas(one_block, "group string, shard int")
    light = materialize(light, "group-shards")
    whole, cut = placed.filter("not cut").select("group", "shard"), placed.filter("cut")
    cut_groups = cut.select("group").distinct()
    members = numbered(rows.join(F.broadcast(cut_groups), "group", "left_semi"), ["group"], ["id"], "member")
    inside = (members["group"] == cut["group"]) & (F.col("member") >= F.col("low")) & (F.col("member") < F.col("high"))
    members = members.join(F.broadcast(cut), inside).select("id", "size", "crc", "shard")  # both sides of few groups
    of_light = rows.join(F.broadcast(placed.select("group").distinct()), "group", "left_anti").join(light, "group")
    of_whole = rows.join(F.broadcast(whole), "group")  # a shard's worth of rows may share one key
    placed_rows = of_light.select("id", "size", "crc", "shard").union(of_whole.select("id", "size", "crc", "shard")).union(members)
    out = numbered(placed_rows, ["shard"], ["id", "crc"], "slot")
    return out.select(F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def op6_sharding(spark, folder: str) -> DataFrame:
    ready(spark)
    found = assign(read(spark, folder, "documents"), 24)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
