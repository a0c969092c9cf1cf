"""Blocked Bloom filter as a small table: keeps rows that surely match nothing out of a shuffle join.

The filter has one 256-bit block per row; a key sets or tests one bit in each of the eight 32-bit words of its block. Its
size is bounded by ``MAX_BLOCKS`` whatever the number of keys: beyond that more rows pass and are joined, and the exact
join behind the filter gives the same result.
"""

from pyspark.sql import functions as F

from kerbline.llm.frames import written

WORDS = 8
MAX_BLOCKS = 1 << 16
KEYS_PER_BLOCK = 16


def _bits(key, blocks):
    """Block number and one single-bit mask per word."""
    code = F.xxhash64(key)
    block = F.pmod(F.shiftrightunsigned(code, 40), F.lit(blocks))
    spots = [F.shiftrightunsigned(code, 5 * i).bitwiseAND(F.lit(31)) for i in range(WORDS)]
    return block, [F.call_function("shiftleft", F.lit(1).cast("long"), spot.cast("int")) for spot in spots]


def block_count(n_keys, max_blocks=MAX_BLOCKS):
    """A block for each 16 keys, within the bound."""
    wanted = max(1, -(-n_keys // KEYS_PER_BLOCK))
    return min(max_blocks, 1 << (wanted - 1).bit_length())


def table(keys, key, blocks):
    """One row per used block: its eight words. At most ``blocks`` rows, whatever the number of keys."""
    block, masks = _bits(key, blocks)
    rows = keys.where(key.isNotNull()).select(block.alias("block"), *[m.alias(f"word{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"word{i}").alias(f"word{i}") for i in range(WORDS)])


def probe(df, key, blocks_table, blocks):
    """``df`` as one struct column ``row``, with ``maybe``: false where the key surely is none of the filter's."""
    block, masks = _bits(F.col("key"), blocks)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("key"))
    # bounded: at most MAX_BLOCKS rows of nine longs
    probed = rows.withColumn("block", block).join(F.broadcast(blocks_table), "block", "left")
    passes = F.col("key").isNotNull() & F.col("word0").isNotNull()
    for i, mask in enumerate(masks):
        passes = passes & (F.col(f"word{i}").bitwiseAND(mask) != 0)
    return probed.select("row", F.coalesce(passes, F.lit(False)).alias("maybe"))


def split(df, key, keys, of_keys, max_blocks=MAX_BLOCKS):
    """(rows of ``df`` whose key is surely not in ``keys``, rows whose key may be)."""
    blocks = block_count(keys.count(), max_blocks)
    probed = probe(df, key, table(keys, of_keys, blocks), blocks)
    return probed.where(~F.col("maybe")).select("row.*"), probed.where("maybe").select("row.*")


def without(rows, dropped):
    """The documents of ``rows`` (see ``located``) but for those at the dropped places (file_id, row); texts that surely
    stay are not shuffled."""
    place = F.struct(F.xxhash64("file").alias("file_id"), F.col("row"))
    dropped = written(dropped, "dropped")
    sure, maybe = split(rows, place, dropped, F.struct("file_id", "row"))
    same = (F.xxhash64(maybe["file"]) == dropped["file_id"]) & (maybe["row"] == dropped["row"])
    return sure.select("doc.*").unionByName(maybe.join(dropped, same, "left_anti").select("doc.*"))
