"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

1. Rows are numbered where they lie (one narrow written table); at most ``CHUNK`` neighbours form a partition.
2. How many rows each partition sends to each shard is drawn exactly as a uniform permutation would give it. The draw goes down
   a binary tree over the partitions: a node holds how many rows of each shard lie below it and deals them to its two
   children by a multivariate hypergeometric draw. All nodes of a level are drawn side by side.
3. Each partition permutes its rows at random and cuts them into runs, one for each shard.
4. After the exchange each shard permutes again. The order is that of a random key, counted within ranges of the key, so no
   task sees a whole shard.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
#: Draws look at so many standard deviations around the mode; what lies outside has a weight under 1e-20.
SPREAD = 10


def uniform(*parts: Column) -> Column:
    """A number in (0, 1), fixed by its parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def hypergeometric(u: Column, good: Column, total: Column, draws: Column) -> Column:
    """Number of good ones among ``draws`` of ``total``, by inverting the distribution function at ``u``.

    Weights relative to the first term follow from their ratio, so no factorials are needed; two passes over the terms, one
    for their sum and one for the place of ``u``.
    """
    lowest, highest = F.greatest(F.lit(0).cast("long"), draws + good - total), F.least(good, draws)
    mean = draws.cast("double") * good / F.greatest(total, F.lit(1))
    deviation = F.sqrt(F.greatest(mean * (1 - good / F.greatest(total, F.lit(1))), F.lit(0.0)))
    reach = F.ceil(deviation * SPREAD + SPREAD)
    first = F.greatest(lowest, F.floor(mean) - reach)
    last = F.least(highest, F.floor(mean) + reach)

    def ratio(k: Column) -> Column:
        return (good - k).cast("double") * (draws - k) / ((k + 1).cast("double") * (total - good - draws + k + 1))

    one = F.lit(1.0)
    start = F.struct(one.alias("w"), one.alias("sum"))

    def add(s: Column, k: Column) -> Column:
        w = s["w"] * ratio(k)
        return F.struct(w.alias("w"), (s["sum"] + w).alias("sum"))

    steps = F.sequence(first, last - 1)
    whole = F.aggregate(steps, start, add, lambda s: s["sum"])

    def seek(s: Column, k: Column) -> Column:
        w = s["w"] * ratio(k)
        below = s["sum"] < s["goal"]
        return F.struct(
            w.alias("w"), (s["sum"] + w).alias("sum"), s["goal"].alias("goal"), F.when(below, k + 1).otherwise(s["k"]).alias("k")
        )

    seeking = F.struct(one.alias("w"), one.alias("sum"), (u * whole).alias("goal"), first.alias("k"))
    return F.when(last <= first, first).otherwise(F.aggregate(steps, seeking, seek, lambda s: s["k"]))


def deal(seed: int, node: Column, level: int, counts: Column, draws: Column) -> Column:
    """How many of ``counts`` (rows by shard) fall to a child that holds ``draws`` rows: one draw for each shard in turn."""
    empty = F.array().cast("array<bigint>")
    whole = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    start = F.struct(empty.alias("out"), whole.alias("total"), draws.alias("draws"))

    def step(s: Column, good: Column) -> Column:
        u = uniform(F.lit(seed), F.lit(level), node, F.size(s["out"]))
        k = hypergeometric(u, good, s["total"], s["draws"])
        return F.struct(
            F.concat(s["out"], F.array(k)).alias("out"), (s["total"] - good).alias("total"), (s["draws"] - k).alias("draws")
        )

    return F.aggregate(counts, start, step, lambda s: s["out"])


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, counts array<long>) from (part long, rows long): rows that each partition sends to each shard.

    Row sums are the partitions' sizes; column sums are the shards' exact sizes, at most one apart. ``sizes`` has a row for each
    partition; it is numbered in one task, which sees that summary only.
    """
    indexed = sizes.select("part", "rows", (F.row_number().over(Window.orderBy("part")) - 1).cast("long").alias("node"))
    leaves = write_intermediate(indexed, "shard-parts")
    n, rows = leaves.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    depth = max(0, int(n) - 1).bit_length()
    whole = [int(rows) // shards + (1 if s < int(rows) % shards else 0) for s in range(shards)]
    spark = sizes.sparkSession
    nodes = spark.range(1 if n else 0).select(F.lit(0).cast("long").alias("node"), F.array(*[F.lit(w).cast("long") for w in whole]).alias("counts"))
    for level in range(depth):
        width = depth - level - 1
        child = F.shiftright("node", width)
        left = leaves.where(child.bitwiseAND(F.lit(1)) == 0).groupBy(F.shiftright("node", width + 1).alias("node")).agg(F.sum("rows").alias("left_rows"))
        right = leaves.where(child.bitwiseAND(F.lit(1)) == 1).groupBy(F.shiftright("node", width + 1).alias("node")).agg(F.lit(True).alias("has_right"))
        dealt = nodes.join(left, "node").join(right, "node", "left").select(
            "node", "counts", F.col("has_right").isNotNull().alias("both"),
            F.when(F.col("has_right").isNull(), F.col("counts")).otherwise(deal(seed, F.col("node"), level, F.col("counts"), F.col("left_rows"))).alias("mine"),
        )
        dealt = write_intermediate(dealt, "shard-level")
        rest = F.zip_with("counts", "mine", lambda a, b: a - b)
        nodes = dealt.select((F.col("node") * 2).alias("node"), F.col("mine").alias("counts")).unionByName(
            dealt.where("both").select((F.col("node") * 2 + 1).alias("node"), rest.alias("counts"))
        )
    return leaves.join(nodes, "node").select("part", "counts")


def assign(rows: DataFrame, shards: int, seed: int = 0, range_rows: int = CHUNK) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    Every permutation of the rows is equally likely up to the hash's quality, and shard sizes differ by one at most. The result is
    fixed by the seed and by how the rows lie in their files. Equal rows, null values and rows of one hot key are told
    apart by their place, so nothing is skewed. An empty table gives an empty result. ``rows`` should be narrow: it is
    written once and exchanged twice. The column names ``shard``, ``slot`` and those starting with ``__`` are taken.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    placed = write_intermediate(rows.withColumn("__place", F.monotonically_increasing_id()), "shard-rows")
    placed = placed.withColumn("__part", F.shiftright("__place", CHUNK_BITS))
    sizes = placed.groupBy(F.col("__part").alias("part")).agg(F.count("*").alias("rows"))
    matrix = communication_matrix(sizes, shards, seed).select(F.col("part").alias("__part"), F.col("counts").alias("__counts"))
    local = Window.partitionBy("__part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), "__place"), "__place")
    ends = F.aggregate(
        "__counts", F.array().cast("array<bigint>"), lambda s, c: F.concat(s, F.array(c + F.coalesce(F.get(s, F.size(s) - 1), F.lit(0).cast("long"))))
    )
    sent = (
        placed.withColumn("__order", F.row_number().over(local))
        .join(matrix, "__part")
        .withColumn("shard", F.size(F.filter(ends, lambda e: e < F.col("__order"))))
        .drop("__counts", "__order", "__part")
    )
    sent = write_intermediate(sent.withColumn("__key", F.xxhash64(F.lit(seed), F.lit("exchanged"), "__place")), "shard-sent")
    n = sent.count()
    bits = max(0, -(-n // (shards * range_rows)) - 1).bit_length()
    span = F.shiftrightunsigned("__key", 64 - bits) if bits else F.lit(0).cast("long")
    sent = sent.withColumn("__span", span)
    ranges = sent.groupBy("shard", "__span").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy("shard").orderBy("__span").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("shard", "__span", F.coalesce(F.sum("__rows").over(before), F.lit(0).cast("long")).alias("__offset"))
    inside = Window.partitionBy("shard", "__span").orderBy(F.shiftleft("__key", bits) if bits else F.col("__key"), "__place")
    out = sent.withColumn("__rank", F.row_number().over(inside)).join(ranges, ["shard", "__span"])
    return out.withColumn("slot", (F.col("__offset") + F.col("__rank") - 1).cast("long")).drop("__place", "__key", "__span", "__offset", "__rank")


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of all rows; size is the text's UTF-8 bytes plus 1, a null text has none."""
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    return assign(narrow, shards, seed)
