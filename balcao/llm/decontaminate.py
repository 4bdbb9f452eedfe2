"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Documents are partitioned by the power of two above their number of shingles. One permutation of the shingles is cut into bins, in
proportion to the partition's upper size, and a document's signature is the smallest value of each bin. So the signature of a long
document grows with it, and a short test item is as likely to be found there as in a short text: a shared shingle is the
minimum of its bin with probability (1 - exp(-f)) / f or more, f being the mean fill of a full bin. A test item probes the
signatures with its shingles; a pair that agrees in enough values is a candidate, and its containment is counted exactly.

The fill is not a guess: it is halved until the shortest item of the benchmark is missed with probability under ``MISS``, down to
signatures that hold every shingle.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate

WIDTH = 5
MISS = 1e-4
#: A benchmark of at most so many (item, shingle) rows of 24 bytes is broadcast; a larger one is joined by exchange.
BROADCAST_ROWS = 400_000
#: Signature values are counted per pair; a candidate may lie so many standard deviations below the expected count.
DEVIATIONS = 5.0
#: A document's candidate items are verified in so many slices, each by itself.
ITEM_SLICES = 64


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def with_shingles(rows: DataFrame, text_col: str, width: int) -> DataFrame:
    """``rows`` with ``hashes`` in place of the text: a hash of every run of ``width`` words, with repeats.

    A shorter text has one shingle of all its words, an empty one none. Words are a column of their own, since an expression
    inside a lambda is evaluated for every element.
    """
    w, n = F.col("__words"), F.size("__words")
    runs = F.transform(F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    hashes = F.when(n >= width, runs).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return rows.withColumn("__words", words(F.col(text_col))).withColumn("hashes", hashes).drop("__words", text_col)


def signed(rows: DataFrame, fill_bits: int) -> DataFrame:
    """``rows`` with ``signature`` in place of ``hashes``: the smallest value of each bin.

    A text of 2**(b-1) < n <= 2**b shingles has 2**(b + fill_bits) bins. Bins are the highest bits of the hash, so the
    sorted hashes lie bin by bin.
    """
    bits = F.least(F.ceil(F.log2(F.greatest(F.size("hashes"), F.lit(1)))).cast("int") + fill_bits, F.lit(63))
    rows = rows.select("*", F.sort_array("hashes").alias("__ordered"), (F.lit(64) - bits).alias("__shift")).drop("hashes")
    bin_of = lambda x: F.call_function("shiftright", x, F.col("__shift"))
    first = F.filter("__ordered", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("__ordered", i - 1))))
    signature = F.when(F.col("__shift") < 64, first).otherwise(F.slice("__ordered", 1, 1))
    return rows.withColumn("signature", signature).drop("__ordered", "__shift")


def kept_share(fill_bits: int) -> float:
    """Least probability that a shingle is the minimum of its bin."""
    fill = 2.0**-fill_bits
    return -math.expm1(-fill) / fill


def fill_for(fewest: int) -> int:
    """Bits by which the bins outnumber the shingles, so that ``fewest`` shared shingles are all missed under ``MISS``."""
    bits = 0
    while (1 - kept_share(bits)) ** fewest > MISS and bits < 40:
        bits += 1
    return bits


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows with a null or repeated id apart: two independent hashes of id and text. Equal rows share it."""
    return F.struct(F.xxhash64(id_col, text_col).alias("h1"), F.xxhash64(F.lit(1), text_col, id_col).alias("h2"))


def _probing(rows: DataFrame, many: bool) -> DataFrame:
    return rows if many else F.broadcast(rows)


def _short_matches(texts: DataFrame, items: DataFrame, width: int, many: bool) -> DataFrame | None:
    """(doc, id, item) of items under ``width`` words: their only shingle is all their words, looked for among the runs of as many words
    in each text. There are ``width`` - 1 lengths at most, and only those that occur are made."""
    found = None
    for m in sorted(r[0] for r in items.select("n_words").distinct().collect()):
        probing = items.where(F.col("n_words") == m).select("item", F.explode("item_hashes").alias("value"))
        runs = with_shingles(texts, "text", m).where(F.size("hashes") > 0)
        one = runs.select("doc", "id", F.explode_outer(F.array_distinct("hashes")).alias("value")).join(_probing(probing, many), "value").select("doc", "id", "item")
        found = one if found is None else found.unionByName(one)
    return found


def matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc, id, item, n_item, n_shared, containment) of every row of ``docs`` by its ``row_key``, and every item found in it."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    items = items.withColumn("n_words", F.size(words(F.col("text"))))
    items = with_shingles(items, "text", width).select("item", "n_words", F.array_distinct("hashes").alias("item_hashes"))
    items = items.withColumn("n_item", F.size("item_hashes")).withColumn("need", F.ceil(F.col("n_item") * threshold).cast("int"))
    items = write_intermediate(items, "decontaminate-items").where("n_item > 0")
    short, items = items.where(F.col("n_words") < width), items.where(F.col("n_words") >= width)
    fewest, probes = items.agg(F.min("need"), F.sum("n_item")).first()
    bits = fill_for(int(fewest or 1))
    share = kept_share(bits)
    probing = _probing(items.select("item", "need", F.explode("item_hashes").alias("value")), (probes or 0) > BROADCAST_ROWS)
    texts = docs.select(row_key(id_col, text_col).alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # explode would have Spark infer a filter on the signature and push it, with all that makes it, below the steps above.
    values = signed(with_shingles(texts, "text", width), bits).select("doc", F.explode_outer("signature").alias("value"))
    expected = F.col("need") * share
    enough = F.greatest(F.lit(1.0), F.floor(expected - DEVIATIONS * F.sqrt(expected * (1 - share))))
    # Rows with one key, which are equal, are counted together: that can only add candidates, which are counted exactly below.
    pairs = values.join(probing, "value").groupBy("doc", "item", "need").agg(F.count("*").alias("agree")).where(F.col("agree") >= enough)
    wanted = pairs.select("doc", "item").join(items.select("item", "n_item", "item_hashes"), "item")
    # A text that holds much of the benchmark meets it in bounded slices of items.
    slices = F.pmod(F.xxhash64("item"), F.lit(ITEM_SLICES))
    wanted = wanted.groupBy("doc", slices.alias("slice")).agg(F.collect_list(F.struct("item", "n_item", "item_hashes")).alias("items"))
    wanted = write_intermediate(wanted, "decontaminate-candidates")
    counted = with_shingles(texts.join(wanted.hint("merge"), "doc"), "text", width).select("doc", "id", "items", F.array_distinct("hashes").alias("held"))
    shared = F.transform(
        "items", lambda i: F.struct(i["item"].alias("item"), i["n_item"].alias("n_item"), F.size(F.array_intersect("held", i["item_hashes"])).alias("n_shared"))
    )
    counted = counted.select("doc", "id", F.explode(shared).alias("i"))
    containment = (F.col("i.n_shared") / F.col("i.n_item")).alias("containment")
    met = counted.select("doc", "id", "i.item", "i.n_item", "i.n_shared", containment).where(F.col("containment") >= threshold)
    brief = _short_matches(texts, short, width, short.count() > BROADCAST_ROWS)
    if brief is not None:
        one = F.lit(1)
        met = met.unionByName(brief.select("doc", "id", "item", one.alias("n_item"), one.alias("n_shared"), F.lit(1.0).alias("containment")))
    return met


def find(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, item, n_item, n_shared, containment): every pair whose share of the item's distinct shingles in the document reaches
    ``threshold``.

    Words are runs of letters and digits in lower case. Texts without words and null texts take no part. An item under
    ``width`` words is found where all its words stand in a row. Rows that repeat a document's or item's id give one row with the
    best containment, and so do all rows with a null id; a null item id takes no part. Other columns are not read. Empty tables
    give an empty result.
    """
    met = matches(docs, benchmark, threshold, width, id_col, text_col, item_col, item_text_col)
    best = F.max(F.struct("containment", "n_shared", "n_item"))
    return met.groupBy("id", "item").agg(best.alias("b")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("b.n_item").cast("long").alias("n_item"),
        F.col("b.n_shared").cast("long").alias("n_shared"), "b.containment",
    )


def remove(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that hold no test item. Each row is judged by its own text, also where ids are null or repeat."""
    leaked = matches(docs, benchmark, threshold, width).select(F.col("doc").alias("__row")).distinct()
    return docs.join(leaked, row_key("doc_id", "text") == F.col("__row"), "left_anti")


#: The same pairs by an exact join of all shingles. Parameters: width, threshold.
SQL = r"""
WITH ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(generate_series(1, greatest(len(w) - {width} + 1, 1)), lambda i: array_to_string(w[i:i + {width} - 1], ' '))) AS s
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents) WHERE len(w) > 0
),
bw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bs AS (
  SELECT DISTINCT item_id, unnest(list_transform(generate_series(1, len(w) - {width} + 1), lambda i: array_to_string(w[i:i + {width} - 1], ' '))) AS s
  FROM bw WHERE len(w) >= {width}
),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
brief AS (SELECT DISTINCT item_id, ' ' || array_to_string(w, ' ') || ' ' AS run FROM bw WHERE len(w) BETWEEN 1 AND {width} - 1)
SELECT DISTINCT doc_id, item_id, CAST(1 AS BIGINT) AS n_item, CAST(1 AS BIGINT) AS n_shared, CAST(1 AS DOUBLE) AS containment
FROM (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), ' ') || ' ' AS said FROM documents) d
JOIN brief ON contains(said, run)
UNION ALL
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) / n_item >= {threshold}
"""
