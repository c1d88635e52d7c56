"""Removal of repeated runs of lines, with DataFrame operations only.

The lines of all documents form sequences of line ids. Prefix doubling sorts the suffixes of these sequences by their
first 1, 2, 4, ... lines: the rank of 2k lines at a place comes from the ranks of k lines there and k lines further on.
Ranks keep the order of the suffixes (range partitions, sorted, numbered upwards), so equal ranks are one interval of
the suffix array whose members have a common prefix of that many lines. Only suffixes that share their prefix with
another one go into the next round. The last step overlaps, so that any length can be reached. Sorting stops at
``min_lines``: a longer common prefix is a chain of intervals at consecutive places.

A run of at least ``min_lines`` lines, or a single line of at least ``min_chars`` characters, that occurs earlier too
(smaller key, or earlier in the document) is deleted; runs that touch or overlap are joined to maximal ones. The first
copy stays. Repetition is judged on the input, not on what is left.

Defined cases: null and empty texts have no lines and stay as they are. Rows that agree in key and text are one document
and get the same result. A null key sorts before all others. An emptied document keeps an empty text. Ties don't exist:
places are ordered by key, hash of the text and line number. An empty table gives an empty result. Other columns are
kept; the added ones are ``n_lines``, ``n_removed``, ``n_runs`` (or as ``names`` says) and replace any of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardmill.llm.tables import fresh, read, ready
from cardmill.session import materialize

MIN_LINES = 3
MIN_CHARS = 120
PLACE = ["doc", "hash"]


def _ranked(places: DataFrame, by: list[str], label: str) -> DataFrame:
    """Places whose value of ``by`` occurs more than once: rank, and whether an earlier place has the same rank."""
    groups = places.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct(*PLACE, "pos")).alias("first")).filter("n > 1")
    ordered = groups.drop("n").repartitionByRange(*by).sortWithinPartitions(*by).withColumn("new", F.monotonically_increasing_id())
    ordered = materialize(ordered, f"{label}-groups")  # the numbering must not change between its readers
    later = F.struct(*PLACE, "pos") > F.col("first")
    kept = [c for c in places.columns if c not in by]
    return materialize(places.join(ordered, by).select(*kept, F.col("new").alias("rank"), later.alias("later")), label)


def _following(ranked: DataFrame, shift: int) -> DataFrame:
    ahead = ranked.select(*PLACE, (F.col("pos") - shift).alias("pos"), F.col("rank").alias("next"))
    return ranked.select(*PLACE, "pos", "rank").join(ahead, [*PLACE, "pos"])


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Maximal runs of lines to delete (doc, hash, start, length) from rows (doc, hash, text)."""
    lines = docs.filter("text <> ''").select(*PLACE, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    ids = lines.select(
        *PLACE, "pos", F.xxhash64("line").alias("p"), F.xxhash64(F.lit(1), F.reverse("line")).alias("q"), (F.length("line") >= min_chars).alias("long")
    ).dropDuplicates([*PLACE, "pos"])
    ranked = _ranked(ids, ["p", "q"], "lines-1")
    later = ranked.filter("later and long").select(*PLACE, "pos", F.lit(1).alias("length"))
    depth = 1
    while depth < min_lines:
        shift = min(depth, min_lines - depth)
        ranked = _ranked(_following(ranked, shift), ["rank", "next"], f"lines-{depth + shift}")
        depth += shift
    later = later.union(ranked.filter("later").select(*PLACE, "pos", F.lit(min_lines).alias("length")))

    covered = later.select(*PLACE, F.explode(F.sequence("pos", F.col("pos") + F.col("length") - 1)).alias("pos")).distinct()
    place = Window.partitionBy(*PLACE).orderBy("pos")
    islands = covered.withColumn("island", F.col("pos") - F.row_number().over(place))
    return islands.groupBy(*PLACE, "island").agg(F.min("pos").alias("start"), F.count("*").cast("int").alias("length")).drop("island")


def remove_repeated_lines(
    docs: DataFrame, key="doc_id", text_column="text", min_lines=MIN_LINES, min_chars=MIN_CHARS, names=("n_lines", "n_removed", "n_runs")
) -> DataFrame:
    """``docs`` without later copies of repeated line runs, and counts of lines, removed lines and runs (long)."""
    doc = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    keyed = docs.select(doc.alias("doc"), F.xxhash64(text_column).alias("hash"), F.col(text_column).alias("text"))
    runs = repeated_runs(keyed, min_lines, min_chars)
    runs = runs.groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("__runs"))  # of one document
    by_doc, by_hash, found = (fresh(docs, c) for c in ("__doc", "__hash", "__runs"))
    runs = runs.toDF(by_doc, by_hash, found)
    joined = docs.join(runs, (doc == F.col(by_doc)) & (F.xxhash64(text_column) == F.col(by_hash)), "left")

    lines = F.split(text_column, "\n")
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda r: r["start"] + r["length"]))
    ends = F.concat(F.transform(found, lambda r: r["start"]), F.array(F.size(lines)))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"]))
    text = F.when(F.col(found).isNull(), F.col(text_column)).otherwise(F.array_join(F.flatten(kept), "\n"))
    total = F.when(F.coalesce(F.length(text_column), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(lines))
    removed = F.coalesce(F.aggregate(found, F.lit(0), lambda s, r: s + r["length"]), F.lit(0))
    count = F.coalesce(F.when(F.col(found).isNotNull(), F.size(found)), F.lit(0))
    return joined.select(
        *[text.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns if c not in names],
        *[x.cast("long").alias(n) for x, n in zip((total, removed, count), names)],
    )


def op1_lines(spark, folder: str) -> DataFrame:
    ready(spark)
    found = remove_repeated_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH line AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text <> '')
), three AS (
  SELECT *, lead(line, 1) OVER d AS second, lead(line, 2) OVER d AS third FROM line WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos, 1 AS length FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS copy FROM line)
  WHERE copy > 1 AND length(line) >= 120
  UNION ALL
  SELECT doc_id, pos, 3 FROM (
    SELECT *, row_number() OVER (PARTITION BY line, second, third ORDER BY doc_id, pos) AS copy FROM three WHERE third IS NOT NULL)
  WHERE copy > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + length)) AS pos FROM later
), marked AS (
  SELECT line.doc_id, line.pos, line, gone.pos IS NOT NULL AS removed FROM line LEFT JOIN gone ON gone.doc_id = line.doc_id AND gone.pos = line.pos
), begun AS (
  SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM marked
), counted AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, count(*) FILTER (begins) AS n_runs,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '') AS kept
  FROM begun GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted ON counted.doc_id = d.doc_id
"""
