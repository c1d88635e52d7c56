"""CSV and JSON source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardmill.session import materialize


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header; an empty field is NULL, also when it is quoted."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
        .select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in schema.names])
    )


def explode_json_map(df: DataFrame, text: str, key: str, value: str, inner: str | None = None) -> DataFrame:
    """One row per entry of the JSON object in column ``text``.

    ``inner`` names a member to use instead of the object itself where it is
    present. Of equal keys in one row the last one counts; without other columns, of all rows.
    """
    entries = F.from_json(F.col(text), "map<string,string>")
    if inner:
        entries = F.coalesce(F.from_json(F.get_json_object(F.col(text), f"$.{inner}"), "map<string,string>"), entries)
    others = [c for c in df.columns if c != text]
    row = "_row"
    numbered = df.withColumn("_entries", entries).withColumn(row, F.monotonically_increasing_id())
    exploded = numbered.select(*others, row, F.posexplode("_entries").alias("_pos", key, value))
    last = Window.partitionBy(key, *([row] if others else [])).orderBy(*[F.col(c).desc() for c in (row, "_pos")])
    return exploded.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").select(*others, key, value)


_SPLIT = ("_file", "_block")

# An entry of two short texts in which nothing is escaped: its texts are what stands between the quotes.
_PLAIN = r'^[ \t\r\n]*"[^"\\\x00-\x1F]*"[ \t\r\n]*:[ \t\r\n]*"[^"\\\x00-\x1F]*"[ \t\r\n]*\z'
_PLAIN_LENGTH = 10_000


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _opened(bare: Column, inside: bool) -> Column:
    """Braces that a piece leaves open; a piece that begins inside a string gets its opening quote back first."""
    outside = F.regexp_replace(F.concat(F.lit('"' if inside else ""), bare), r'"[^"]*("|$)', "")
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "}") - _count(outside, "]")


def _measured(pieces: DataFrame) -> DataFrame:
    """Quotes and open braces before each piece within its split, for either case: the split begins outside of a string, or inside."""
    bare = F.regexp_replace("value", r"\\.", "")
    before = Window.partitionBy(*_SPLIT).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    measured = pieces.withColumns({"_quotes": _count(bare, '"') % 2, "_apart": _opened(bare, False), "_within": _opened(bare, True)})
    odd = F.coalesce(F.sum("_quotes").over(before), F.lit(0)) % 2
    chosen = measured.withColumn("_odd", odd).withColumns(
        {
            "_opens0": F.when(F.col("_odd") == 1, F.col("_within")).otherwise(F.col("_apart")),
            "_opens1": F.when(F.col("_odd") == 1, F.col("_apart")).otherwise(F.col("_within")),
        }
    )
    depth = {f"_depth{i}": F.coalesce(F.sum(f"_opens{i}").over(before), F.lit(0)) for i in (0, 1)}
    return chosen.withColumns(depth).drop("_apart", "_within")


def _split_starts(measured: DataFrame, wrapper: str) -> DataFrame:
    """For each split: whether it begins inside a string, the depth it begins at, and the depth of its file's entries."""
    splits = measured.groupBy(*_SPLIT).agg(
        *(F.sum(c).alias(c) for c in ("_quotes", "_opens0", "_opens1")), F.min_by("value", "_line").alias("_first")
    )
    in_file = Window.partitionBy("_file").orderBy("_block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    begun = splits.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2)
    opened = F.when(F.col("_inside") == 1, F.col("_opens1")).otherwise(F.col("_opens0"))
    return begun.withColumn("_open", opened).select(
        *_SPLIT,
        F.dense_rank().over(Window.orderBy("_file")).alias("_number"),
        "_inside",
        F.coalesce(F.sum("_open").over(earlier), F.lit(0)).alias("_start"),
        F.when(F.first("_first").over(in_file).rlike(wrapper), 2).otherwise(1).alias("_base"),
    )


def _put_together(pieces: DataFrame) -> DataFrame:
    """Entries of several pieces: each piece goes to the last one before it, in its split or an earlier one, that opens an entry."""
    opening = F.when(F.col("_opens"), F.struct("_block", "_line"))
    so_far = Window.partitionBy(*_SPLIT).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    last = pieces.groupBy(*_SPLIT).agg(F.max(opening).alias("_last"))
    carried = last.select(*_SPLIT, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    local = pieces.withColumn("_own", F.last(opening, ignorenulls=True).over(so_far))
    owned = local.join(carried, [*_SPLIT], "left").withColumn("_entry", F.coalesce("_own", "_carried"))
    return owned.groupBy("_file", "_base", "_entry").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_block", "_line", "value")))["value"], ",").alias("value"),
        F.min("_depth").alias("_depth"),
        F.max_by("_after", F.struct("_block", "_line")).alias("_after"),
    )


def read_json_entries(
    spark: SparkSession, path: str, key: str = "key", value: str = "value", inner: str | None = None
) -> DataFrame:
    """Entries of files ``{key: value, ...}`` of any size: key, value, rejected.

    Files are cut at commas wherever that is, so one line is read by many tasks. A cut counts if the quotes before it
    are even and the braces before it leave the depth of the entries; other pieces are put together again. Each split is
    measured for both ways it can begin and stored; a scan over one row for each split then says which one holds, and
    these rows go to all tasks, so the pieces are not moved again. Values
    come as text (a nested one as its JSON). What is no entry comes as text in ``rejected``. Where ``inner`` opens the
    file, the entries of that member are taken. Of equal keys the last one counts.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    measured = materialize(_measured(pieces), "json-pieces")
    wrapper = rf'^\s*\{{\s*"{inner}"\s*:\s*\{{' if inner else r"^\b$"
    inside = F.col("_inside") == 1
    placed = measured.join(F.broadcast(_split_starts(measured, wrapper)), [*_SPLIT]).drop("_file").withColumnRenamed("_number", "_file")
    placed = placed.withColumns(
        {
            "_odd": (F.col("_inside") + F.col("_odd")) % 2,
            "_depth": F.col("_start") + F.when(inside, F.col("_depth1")).otherwise(F.col("_depth0")),
            "_open": F.when(inside, F.col("_opens1")).otherwise(F.col("_opens0")),
        }
    )
    placed = placed.withColumn("_after", F.col("_depth") + F.col("_open")).select(
        "value",
        *_SPLIT,
        "_line",
        "_base",
        "_depth",
        "_after",
        ((F.col("_odd") == 0) & F.col("_depth").isin(0, F.col("_base"))).alias("_opens"),
        (((F.col("_odd") + F.col("_quotes")) % 2 == 0) & F.col("_after").isin(0, F.col("_base"))).alias("_ends"),
    )
    whole = F.col("_opens") & F.col("_ends")
    columns = ("value", "_file", "_entry", "_base", "_depth", "_after")
    single = placed.filter(whole).withColumn("_entry", F.struct("_block", "_line")).select(*columns)
    entries = single.unionByName(_put_together(placed.filter(~whole)).select(*columns))
    opened = F.when(F.col("_base") == 2, F.regexp_replace("value", wrapper, "")).otherwise(F.regexp_replace("value", r"^\s*\{", ""))
    body = F.when(F.col("_depth") == 0, opened).otherwise(F.col("value"))
    closers = F.col("_base") - F.col("_after")
    body = F.when(closers >= 2, F.regexp_replace(body, r"\}\s*\}\s*$", "")).when(closers == 1, F.regexp_replace(body, r"\}\s*$", "")).otherwise(body)
    parsed = entries.select("_file", "_entry", body.alias("_body")).filter(F.col("_body").rlike(r"\S"))
    plain = (F.length("_body") < _PLAIN_LENGTH) & F.col("_body").rlike(_PLAIN)
    other = F.from_json(F.concat(F.lit("{"), F.col("_body"), F.lit("}")), "map<string,string>")
    parsed = parsed.withColumn("_plain", plain).withColumn("_map", F.when(~F.col("_plain"), other))
    is_plain, one, texts = F.col("_plain"), F.col("_plain") | F.coalesce(F.size("_map") == 1, F.lit(False)), F.split("_body", '"')
    rows = parsed.select(
        F.when(is_plain, texts[1]).when(one, F.map_keys("_map")[0]).alias(key),
        F.when(is_plain, texts[3]).when(one, F.map_values("_map")[0]).alias(value),
        F.when(~one, F.col("_body")).alias("rejected"), "_file", "_entry",
    )
    last = Window.partitionBy(key, "rejected").orderBy(F.col("_file").desc(), F.col("_entry").desc())
    return rows.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").select(key, value, "rejected")


def read_json_map(spark: SparkSession, path: str, key: str, value: str, inner: str | None = None) -> DataFrame:
    """The entries of ``read_json_entries`` that could be read."""
    return read_json_entries(spark, path, key, value, inner).filter("rejected IS NULL").drop("rejected")


def read_json_labels(spark: SparkSession, path: str, key: str = "transaction_id", value: str = "is_fraud") -> DataFrame:
    """A label file ``{id: "Yes"/"No", ...}``, also inside ``{"target": ...}``."""
    return read_json_map(spark, path, key, value, "target")
