"""Left joins that add merchant code, card and label attributes.

No join carries a broadcast hint: Spark broadcasts a side whose size it knows to
be small, and otherwise shuffles and lets adaptive execution split hot keys.
Every added side has one row per key, so the row count never changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cardmill.functions import event_time
from cardmill.operators.cleaning import add_event_day, clean_latest
from cardmill.operators.dedup import latest_with_row_key, restore_key
from cardmill.operators.packed import pack, unpack
from cardmill.schemas import RAW

UNKNOWN = "UNKNOWN"

CODE_SALTS = 64

CARD_ATTRIBUTES = ("card_brand", "card_type", "card_number_masked", "card_on_dark_web")


def add_mcc_description(txns: DataFrame, mcc: DataFrame) -> DataFrame:
    """A missing code stays NULL; a code without a description becomes UNKNOWN."""
    # Few codes, very many rows each: where the code side is not broadcast, a salt spreads a code over many tasks.
    salts = mcc.select("mcc", "mcc_description", F.explode(F.sequence(F.lit(0), F.lit(CODE_SALTS - 1))).alias("_salt"))
    salted = txns.drop("mcc_description").withColumn("_salt", F.pmod(F.xxhash64("transaction_id"), F.lit(CODE_SALTS)).cast("int"))
    joined = salted.join(salts, ["mcc", "_salt"], "left").drop("_salt")
    described = F.when(F.col("mcc").isNotNull(), F.coalesce("mcc_description", F.lit(UNKNOWN)))
    return joined.withColumn("mcc_description", described)


def add_card_attributes(txns: DataFrame, cards: DataFrame) -> DataFrame:
    return txns.drop(*CARD_ATTRIBUTES).join(cards.select("card_id", *CARD_ATTRIBUTES), "card_id", "left")


def add_labels(txns: DataFrame, labels: DataFrame) -> DataFrame:
    """``is_fraud`` stays NULL until a label arrives."""
    return txns.drop("is_fraud").join(labels.select("transaction_id", "is_fraud"), "transaction_id", "left")


def enrich_transactions(txns: DataFrame, mcc: DataFrame, cards: DataFrame, labels: DataFrame | None) -> DataFrame:
    enriched = add_card_attributes(add_mcc_description(txns, mcc), cards)
    return enriched if labels is None else add_labels(enriched, labels)


def clean_and_enrich(
    raw: DataFrame,
    mcc: DataFrame | None,
    cards: DataFrame | None,
    labels: DataFrame | None,
    tiebreak: Sequence[Column] | None = None,
    packed: Sequence[str] = (),
) -> DataFrame:
    """``enrich_transactions`` of ``clean_transactions``, with the large rows moved twice in their raw, narrow form.

    De-duplication and labels share one shuffle by id, cards take the other. Cleaning makes rows half as wide again and
    comes after both. Sides that are None add nothing: a left join is run even if nothing is taken from it. ``packed`` names
    raw texts that are moved as one: not those of the tiebreak, and only for callers that want all of them.
    """
    carded = _labelled_latest(raw, labels, tiebreak, packed)
    if cards is not None:
        carded = add_card_attributes(carded, cards)
    cleaned = clean_latest(unpack(carded, packed))
    return cleaned if mcc is None else add_mcc_description(cleaned, mcc)


def valid_and_enriched(
    raw: DataFrame,
    mcc: DataFrame,
    cards: DataFrame,
    labels: DataFrame,
    columns: Sequence[str],
    tiebreak: Sequence[Column] | None = None,
    packed: Sequence[str] = (),
) -> DataFrame:
    """The valid rows of ``clean_and_enrich``, cut to ``columns``: rows and columns that go no further aren't moved to the cards.

    Texts that ``raw`` lacks are NULL, so a caller leaves out what none of the columns is made from. Parts of the day are
    taken from the time again, behind the move.
    """
    keyed = raw.filter("id IS NOT NULL")  # rows without an id are never valid
    latest = unpack(_labelled_latest(keyed, labels, tiebreak, packed), packed)
    lacking = {c: F.lit(None).cast("string") for c in RAW["transactions"].names if c not in (*latest.columns, "date")}
    later = ("mcc_description", "year", "month", "day", *CARD_ATTRIBUTES)
    own = list(dict.fromkeys(("transaction_date", "mcc", "card_id", *(c for c in columns if c not in later))))
    valid = clean_latest(latest.withColumns(lacking)).filter("is_valid").select(*own)
    texts = [f.name for f in valid.schema if isinstance(f.dataType, StringType) and f.name != "card_id"]
    carded = unpack(add_card_attributes(pack(valid, texts), cards), texts)
    return add_mcc_description(add_event_day(carded), mcc).select(*columns)


def _labelled_latest(raw: DataFrame, labels: DataFrame | None, tiebreak: Sequence[Column] | None, packed: Sequence[str]) -> DataFrame:
    """The newest raw row of each id with its label, times typed and the texts of ``packed`` as one."""
    own = raw.drop("card_number", "is_fraud", *CARD_ATTRIBUTES)
    if tiebreak is None:
        own = own.withColumn("_whole", F.xxhash64(*own.columns))
    typed = pack(own.withColumn("transaction_date", event_time(F.col("date"))).drop("date"), packed)
    latest = latest_with_row_key(typed, "id", ["_loaded_at"], tiebreak or [F.col("_whole").asc()]).drop("_whole")
    if labels is not None:
        latest = latest.join(labels.select(F.col("transaction_id").alias("_key"), "is_fraud"), "_key", "left")
    return restore_key(latest, "id")
