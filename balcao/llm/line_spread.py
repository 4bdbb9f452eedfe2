"""Line dedup by the spread of lines over distinct sites.

Every line hash gets a HyperLogLog sketch of the sites that show it; sketches merge by aggregation, so a line on a million sites
costs no more memory than one on ten. Lines well above the threshold are boilerplate, lines well below are not. Lines near it
get an exact distinct count. Of a boilerplate line the first appearance stays (lowest document id, then lowest position),
the others are removed.

A text that is copied as a whole may be left to the near-copy stage: ``dedup_lines_of_texts`` counts copies and near copies of a text
as one, so they do not make its lines boilerplate, and keeps their cut texts alike.

Only DataFrame functions are used. Texts are split once into a written table of hashes; the wide texts are exchanged once, and only
to meet the lists of removed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.functions.lineage import write_intermediate
from balcao.llm.decontaminate import WIDTH, with_shingles

#: 2**LG_K registers: a standard error of 1.04 / sqrt(2**LG_K), 6.5 %.
LG_K = 8
#: Estimates within this share of the threshold are counted exactly: four standard errors.
NEAR = 0.26
#: A text that shares this part of its characters, in whole lines, with the text that shows them first is compared with it.
LEAD = 0.2


#: White space at a line's ends.
BLANKS = " \t\r\x0b\x0c"


def lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int, *more: str | Column) -> DataFrame:
    """(doc, site, pos, h1, h2): the lines of at least ``min_words`` words, by two independent hashes.

    ``more`` may add ``version`` and ``total``, the hash and length of the whole text, and what is made of ``line``.
    """
    parts = docs.select(
        F.col(id_col).alias("doc"), F.col(site_col).cast("string").alias("site"), F.xxhash64(text_col).alias("version"),
        F.char_length(text_col).alias("total"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"),
    ).withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return parts.where(F.col("line").rlike(rf"^(\S+\s+){{{max(min_words, 1) - 1}}}\S")).select("doc", "site", "pos", *more, F.xxhash64("line").alias("h1"), F.crc32("line").alias("h2"))


def boilerplate(found: DataFrame, min_sites: int, *more: str) -> DataFrame:
    """(h1, h2, first) of the lines on at least ``min_sites`` distinct sites; ``first`` is their first (doc, pos, *more)."""
    sketched = found.groupBy("h1", "h2").agg(
        F.hll_sketch_agg("site", LG_K).alias("sketch"), F.count("*").alias("n"), F.min(F.struct("doc", "pos", *more)).alias("first")
    )
    spread = sketched.where(F.col("n") >= min_sites).select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = write_intermediate(spread.where(F.col("sites") >= min_sites * (1 - NEAR)), "line-spread")
    sure = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("h1", "h2", "first")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR)).select("h1", "h2", "first")
    exact = (
        found.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2")
        .agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("h1", "h2")
    )
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi"))


def dedup_lines(
    docs: DataFrame, min_sites: int = 10, min_words: int = 3, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source"
) -> DataFrame:
    """All columns of ``docs`` with the text cut, plus ``n_lines`` and ``n_removed``.

    A line is what stands between newlines, without white space at its ends. Lines under ``min_words`` words are never removed.
    A null site counts as no site. A null text stays null with 0 lines; the empty text has one line. Rows with a null id can
    neither be told apart nor lose lines, but their sites count; a line first seen there (nulls come first) stays in every such
    row and goes elsewhere. Rows that repeat an id share its list of removed positions, which is made from all of them. A text
    whose lines all go becomes empty. Input columns named ``n_lines`` or ``n_removed`` are replaced; others pass through.
    """
    docs = docs.drop("n_lines", "n_removed")
    found = write_intermediate(lines(docs, id_col, text_col, site_col, min_words), "line-hashes")
    common = boilerplate(found, min_sites)
    hits = found.join(common, ["h1", "h2"]).where(F.col("doc").isNotNull() & (F.struct("doc", "pos") != F.col("first")))
    removed = hits.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("pos").alias("__removed"))
    return _cut(docs.join(removed, F.col(id_col) == F.col("__doc"), "left"), text_col).drop("__doc")


def _cut(joined: DataFrame, text_col: str) -> DataFrame:
    """``joined`` without the lines at the positions ``__removed``, with ``n_lines`` and ``n_removed``."""
    # The lines are a column of their own, since an expression inside a lambda is evaluated for every element; kept places come from
    # one pass over a hash set, so a text of a million lines is cut in one.
    parted = joined.withColumn("__parts", F.split(text_col, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), "__removed")
    text = F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("__parts"), i)), "\n"))
    none = F.col(text_col).isNull()
    out = parted.withColumns(
        {
            "n_lines": F.when(none, 0).otherwise(F.size("__parts")).cast("long"),
            "n_removed": F.when(none | F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).cast("long"),
            text_col: text,
        }
    )
    return out.drop("__removed", "__parts")


def _leads(found: DataFrame, common: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """(doc, version, lead_version) of the near copies among (doc, version, text): the text that shows most of their common lines
    first and whose shingles agree with theirs in a share of ``threshold``.
    """
    met = found.join(common, ["h1", "h2"]).where("doc IS NOT NULL AND first.doc IS NOT NULL AND version <> first.version")
    share = met.groupBy("doc", "version", F.col("first.doc").alias("lead"), F.col("first.version").alias("lead_version")).agg(
        F.sum("size").alias("size"), F.max(F.greatest("total", "first.total")).alias("longer")
    )
    most = F.max_by(F.struct("lead", "lead_version"), F.struct("size", "lead", "lead_version")).alias("most")
    pairs = share.where(F.col("size") >= F.col("longer") * LEAD).groupBy("doc", "version").agg(most).select("doc", "version", "most.*")
    pairs = write_intermediate(pairs, "line-leads")
    first = texts.select(F.col("doc").alias("lead"), F.col("version").alias("lead_version"), F.col("text").alias("lead_text"))
    both = pairs.join(texts, ["doc", "version"]).join(first, ["lead", "lead_version"])
    both = with_shingles(both, "text", width).withColumn("a", F.array_distinct("hashes")).drop("hashes")
    both = with_shingles(both, "lead_text", width).withColumn("b", F.array_distinct("hashes"))
    both = both.select("doc", "version", "lead_version", F.size("a").alias("n"), F.size("b").alias("m"), F.size(F.array_intersect("a", "b")).alias("k"))
    # A filter here would be pushed below the steps that make the shingles, and find the words again for every shingle.
    counted = write_intermediate(both, "line-near")
    return counted.where(F.col("k") >= threshold * (F.col("n") + F.col("m") - F.col("k")) - 1e-9).select("doc", "version", "lead_version").distinct()


def dedup_lines_of_texts(
    docs: DataFrame, min_sites: int = 10, min_words: int = 3, threshold: float = 0.8, width: int = WIDTH,
    id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
) -> DataFrame:
    """As ``dedup_lines``, for lines on at least ``min_sites`` distinct sites and in as many texts that are no copies of each other.

    Equal texts count as one, and so does a near copy (Jaccard similarity of ``threshold`` over the distinct shingles) with the text that
    shows most of its common lines first. A line that goes stays where it is first in its first document and in all copies of that, so
    copies stay alike for the stage that reduces them. Rows that repeat an id with other texts are told apart.
    """
    docs = docs.drop("n_lines", "n_removed")
    found = lines(docs, id_col, text_col, site_col, min_words, "version", "total", F.char_length("line").alias("size"))
    found = write_intermediate(found, "line-hashes")
    common = write_intermediate(boilerplate(found, min_sites, "version", "total"), "line-common")
    texts = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    near = _leads(found, common, texts, threshold, width)
    candidates = found.join(common.select("h1", "h2"), ["h1", "h2"], "left_semi").join(near, ["doc", "version"], "left")
    candidates = candidates.select("doc", "version", "pos", F.coalesce("lead_version", "version").alias("site"), "h1", "h2")
    candidates = write_intermediate(candidates, "line-texts")
    shared = boilerplate(candidates, min_sites, "site")
    hits = candidates.join(shared, ["h1", "h2"]).where(F.col("doc").isNotNull())
    places = hits.groupBy("doc", "version", "h1", "h2").agg(
        F.collect_set("pos").alias("at"), F.min("pos").alias("least"), F.bool_or(F.col("site") == F.col("first.site")).alias("stays")
    )
    gone = F.filter("at", lambda p: ~F.col("stays") | (p != F.col("least")))
    removed = places.groupBy(F.col("doc").alias("__doc"), F.col("version").alias("__version")).agg(F.flatten(F.collect_list(gone)).alias("__removed"))
    same = (F.col(id_col) == F.col("__doc")) & (F.xxhash64(text_col) == F.col("__version"))
    return _cut(docs.join(removed.where(F.size("__removed") > 0), same, "left"), text_col).drop("__doc", "__version")


#: The same rows by exact counts. Parameters: sites, gaps (words less one).
SQL = r"""
WITH d AS (SELECT doc_id, source, string_split(text, chr(10)) AS parts, text FROM documents),
l AS (
  SELECT doc_id, source, pos - 1 AS pos, trim(parts[pos], chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM (SELECT doc_id, source, parts, unnest(generate_series(1, len(parts))) AS pos FROM d)
),
w AS (SELECT * FROM l WHERE regexp_matches(line, '^(\S+\s+){{{gaps}}}\S')),
b AS (
  SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
  FROM w GROUP BY line HAVING count(DISTINCT source) >= {sites}
),
r AS (SELECT DISTINCT w.doc_id, w.pos FROM w JOIN b USING (line) WHERE (w.doc_id, w.pos) <> (b.first.doc_id, b.first.pos)),
k AS (
  SELECT l.doc_id, string_agg(parts[l.pos + 1], chr(10) ORDER BY l.pos) FILTER (WHERE r.pos IS NULL) AS text,
    count(*) AS n_lines, count(r.pos) AS n_removed
  FROM l JOIN d USING (doc_id) LEFT JOIN r ON r.doc_id = l.doc_id AND r.pos = l.pos GROUP BY l.doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM d LEFT JOIN k USING (doc_id)
"""
