"""Payment tables derived from the test tables.

Each text is plain SQL that Spark and DuckDB read alike. A name in braces is one
of the test tables. The texts only build *inputs* in the shape of the source
tables: text columns with the defects real sources have (missing ids, unreadable
dates, amounts in many notations, repeated rows, contradicting labels). Every row
of the test tables takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardmill import files
from cardmill.session import size_shuffles, small_side

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

RAW_TRANSACTIONS = """
SELECT
  CASE WHEN l_partkey % 89 = 3 THEN NULL
       ELSE CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS id,
  CASE WHEN l_partkey % 97 = 7 THEN 'unknown'
       ELSE day_text || ' ' || lpad(CAST((l_partkey * 7 + l_linenumber) % 24 AS STRING), 2, '0')
            || ':' || lpad(CAST(l_partkey % 60 AS STRING), 2, '0')
            || ':' || lpad(CAST(l_orderkey % 60 AS STRING), 2, '0') END AS date,
  CASE WHEN o_custkey % 71 = 3 THEN NULL ELSE CAST(o_custkey AS STRING) END AS client_id,
  CAST(o_custkey * 10 + l_orderkey % 3 AS STRING) AS card_id,
  CASE (l_orderkey + l_linenumber) % 18
    WHEN 0 THEN '$' || whole || '.' || frac
    WHEN 1 THEN '$-' || whole || '.' || frac
    WHEN 2 THEN '$' || us || '.' || frac
    WHEN 3 THEN eu || ',' || frac
    WHEN 4 THEN whole || '.' || frac
    WHEN 5 THEN '(' || whole || '.' || frac || ')'
    WHEN 6 THEN '₫' || us
    WHEN 7 THEN us
    WHEN 8 THEN eu
    WHEN 9 THEN 'N/A'
    WHEN 10 THEN '€' || whole || ',' || frac
    WHEN 11 THEN ' usd ' || whole || '.' || frac || ' '
    WHEN 12 THEN us || ' VND'
    WHEN 13 THEN CAST(l_linenumber AS STRING) || '.' || rest || '.' || rest
    WHEN 14 THEN CAST(l_linenumber AS STRING) || ',' || rest || ',' || rest
    WHEN 15 THEN CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'abc' WHEN 3 THEN '-$77' WHEN 4 THEN '1.2,3.4'
                 WHEN 5 THEN '£' || eu WHEN 6 THEN '1e3' ELSE '$' END
    WHEN 16 THEN '-' || whole || '.' || frac
    ELSE '$' || whole || '.' || frac END AS amount,
  CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'Swipe Transaction' WHEN 'RO' THEN 'Chip Transaction'
       WHEN 'AF' THEN 'Online Transaction' WHEN 'AO' THEN 'Mobile' END AS use_chip,
  CASE WHEN l_suppkey % 41 = 5 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS merchant_id,
  CASE s_nationkey % 5 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'Online' WHEN 2 THEN NULL
       ELSE 'City ' || CAST(s_nationkey AS STRING) END AS merchant_city,
  CASE s_nationkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'CA' WHEN 2 THEN 'DC' WHEN 3 THEN 'NY' WHEN 4 THEN 'Italy'
       ELSE 'TX' END AS merchant_state,
  CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN CAST(10000 + l_partkey AS STRING) || '.0'
       WHEN 2 THEN CAST(l_partkey AS STRING) || '.0' WHEN 3 THEN 'abc'
       WHEN 4 THEN '-' || CAST(l_linenumber AS STRING) WHEN 5 THEN '123456.0'
       ELSE CAST(20000 + l_suppkey AS STRING) END AS zip,
  CASE l_partkey % 17 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE CAST(l_partkey % 60 AS STRING) END AS mcc,
  CASE (l_orderkey + l_linenumber * 3) % 9 WHEN 0 THEN 'Bad PIN' WHEN 1 THEN 'Bad PIN,Insufficient Balance'
       WHEN 2 THEN 'bad pin' WHEN 3 THEN 'Technical Glitch' WHEN 4 THEN 'Bad CVV,Bad Expiration,'
       WHEN 5 THEN 'Bad Card Number,Bad Zipcode' END AS errors,
  CAST(l_shipdate AS TIMESTAMP) AS _loaded_at,
  CAST(l_shipdate AS TIMESTAMP) AS _ingested_at,
  CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) || '/' || whole || '.' || frac || '/'
    || l_returnflag || l_linestatus AS _source_file,
  'batch_' || substr(day_text, 1, 4) AS _batch_id
FROM (
  SELECT *,
    CASE WHEN units < 1000 THEN whole ELSE CAST(thousands AS STRING) || ',' || rest END AS us,
    CASE WHEN units < 1000 THEN whole ELSE CAST(thousands AS STRING) || '.' || rest END AS eu
  FROM (
    SELECT *,
      CAST(units AS STRING) AS whole,
      lpad(CAST(cents % 100 AS STRING), 2, '0') AS frac,
      CAST((units - units % 1000) / 1000 AS BIGINT) AS thousands,
      lpad(CAST(units % 1000 AS STRING), 3, '0') AS rest
    FROM (
      SELECT *, CAST((cents - cents % 100) / 100 AS BIGINT) AS units
      FROM (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_shipdate,
          o_custkey, s_nationkey, substr(CAST(l_shipdate AS STRING), 1, 10) AS day_text,
          CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {supplier} ON l_suppkey = s_suppkey
      ) priced
    ) counted
  ) split
) written
"""

RAW_USERS = """
SELECT
  CAST(c_custkey AS STRING) AS id,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(10 + c_custkey % 80 AS STRING) END AS current_age,
  CAST(60 + c_custkey % 10 AS STRING) AS retirement_age,
  CAST(1940 + c_custkey % 60 AS STRING) AS birth_year,
  CAST(1 + c_custkey % 12 AS STRING) AS birth_month,
  CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CAST(c_custkey AS STRING) || ' ' || c_mktsegment || ' Street' AS address,
  CAST(c_nationkey AS STRING) || '.25' AS latitude,
  CASE WHEN c_custkey % 37 = 1 THEN 'west' ELSE '-' || CAST(c_nationkey AS STRING) || '.5' END AS longitude,
  '$' || CAST(10000 + c_custkey AS STRING) AS per_capita_income,
  '$' || CAST(20 + c_custkey % 80 AS STRING) || ',' || lpad(CAST(c_custkey % 1000 AS STRING), 3, '0') AS yearly_income,
  CASE WHEN c_custkey % 29 = 2 THEN 'none' ELSE '$' || CAST(c_custkey * 3 AS STRING) END AS total_debt,
  CASE WHEN c_custkey % 23 = 5 THEN NULL ELSE CAST(280 + (c_custkey * 37 + version * 11) % 600 AS STRING) END AS credit_score,
  CAST(1 + c_custkey % 6 AS STRING) AS num_credit_cards,
  CAST(loaded_at AS TIMESTAMP) AS _loaded_at,
  CAST(loaded_at AS TIMESTAMP) AS _ingested_at,
  'users' AS _source_file,
  'batch_' || CAST(version AS STRING) AS _batch_id
FROM (
  SELECT *, 1 AS version, '2020-01-01 00:00:00' AS loaded_at FROM {customer}
  UNION ALL
  SELECT *, 2 AS version, '2021-01-01 00:00:00' AS loaded_at FROM {customer} WHERE c_mktsegment = 'BUILDING'
) versions
"""

RAW_CARDS = """
SELECT
  CAST(o_custkey * 10 + slot AS STRING) AS id,
  CAST(o_custkey AS STRING) AS client_id,
  CASE slot WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Amex' END AS card_brand,
  CASE WHEN o_custkey % 3 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
  CASE o_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '12'
       ELSE '4344-6765-1195-' || lpad(CAST(o_custkey % 10000 AS STRING), 4, '0') END AS card_number,
  CASE WHEN o_custkey % 19 = 4 THEN 'soon'
       ELSE lpad(CAST(1 + o_custkey % 12 AS STRING), 2, '0') || '/' || CAST(2020 + o_custkey % 8 AS STRING) END AS expires,
  lpad(CAST(o_custkey % 1000 AS STRING), 3, '0') AS cvv,
  CASE WHEN o_custkey % 4 = 0 THEN 'NO' WHEN o_custkey % 4 = 1 THEN NULL ELSE 'YES' END AS has_chip,
  CAST(1 + slot AS STRING) AS num_cards_issued,
  '$' || CAST(1000 + o_custkey AS STRING) AS credit_limit,
  CASE WHEN o_custkey % 17 = 6 THEN 'bad' WHEN o_custkey % 17 = 7 THEN NULL
       ELSE lpad(CAST(1 + o_custkey % 12 AS STRING), 2, '0') || '/' || CAST(1995 + o_custkey % 25 AS STRING) END AS acct_open_date,
  CAST(2000 + o_custkey % 20 AS STRING) AS year_pin_last_changed,
  CASE WHEN o_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web,
  CAST(loaded_at AS TIMESTAMP) AS _loaded_at,
  CAST(loaded_at AS TIMESTAMP) AS _ingested_at,
  'cards' AS _source_file,
  'batch_' || CAST(n_orders AS STRING) AS _batch_id
FROM (
  SELECT o_custkey, o_orderkey % 3 AS slot, substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00' AS loaded_at,
    count(*) AS n_orders
  FROM {orders} GROUP BY o_custkey, o_orderkey % 3, substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00'
) loads
"""

RAW_MCC_CODES = """
SELECT DISTINCT CASE WHEN p_size = 13 THEN 'none' ELSE CAST(p_size AS STRING) END AS mcc_code,
  p_type AS description, CAST(NULL AS TIMESTAMP) AS _ingested_at, 'mcc_codes' AS _source_file, 'batch_1' AS _batch_id
FROM {part}
"""

RAW_LABELS = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS transaction_id,
  CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 'Yes' WHEN l_linestatus = 'O' THEN 'NO' ELSE 'No' END AS is_fraud
FROM {lineitem} WHERE l_returnflag <> 'N'
"""

# Typed transactions with a time of day, from the event stream.
EVENT_TRANSACTIONS = """
SELECT CAST(event_id AS STRING) AS transaction_id, CAST(user_id AS STRING) AS user_id,
  CAST(ts AS TIMESTAMP) AS transaction_date,
  CAST(CASE WHEN event_type = 'error' THEN -value ELSE value END AS DECIMAL(18,2)) AS amount,
  CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'CA' WHEN 'view' THEN 'DC' WHEN 'purchase' THEN 'ONLINE'
       ELSE 'NY' END AS merchant_state,
  event_type = 'view' AS card_on_dark_web,
  CASE WHEN event_type = 'click' THEN NULL ELSE event_type = 'error' END AS is_fraud,
  'batch_1' AS _batch_id,
  CAST(EXTRACT(YEAR FROM ts) AS INT) AS year, CAST(EXTRACT(MONTH FROM ts) AS INT) AS month,
  CAST(EXTRACT(DAY FROM ts) AS INT) AS day
FROM {events}
"""

# The event transactions with merchants and codes, some without a merchant, some invalid.
EVENT_PAYMENTS = f"""
SELECT e.*, CASE WHEN CAST(user_id AS BIGINT) % 41 = 5 THEN NULL ELSE 'm' || CAST(CAST(user_id AS BIGINT) % 60 AS STRING) END AS merchant_id,
  'City ' || CAST(CAST(transaction_id AS BIGINT) % 7 AS STRING) AS merchant_city,
  CAST(CAST(transaction_id AS BIGINT) % 5 AS INT) AS mcc,
  CASE CAST(transaction_id AS BIGINT) % 5 WHEN 3 THEN NULL ELSE 'code ' || CAST(CAST(transaction_id AS BIGINT) % 5 AS STRING) END AS mcc_description,
  CAST(transaction_id AS BIGINT) % 11 <> 2 AS is_valid
FROM ({EVENT_TRANSACTIONS}) e
"""

# Versions of three keys, many to a key, with bounds that touch, overlap and are empty; and rows that look them up.
OVERLAPPING_VERSIONS = """
SELECT CAST(o_custkey % 3 AS STRING) AS key, o_orderkey AS version, CAST(o_orderdate AS TIMESTAMP) AS valid_from,
  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS TIMESTAMP) AS valid_to
FROM {orders}
"""
LOOKUPS = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 <> 0 THEN CAST(l_suppkey % 4 AS STRING) END AS key,
  CAST(l_shipdate AS TIMESTAMP) AS shipped_at
FROM {lineitem}
"""

# Three states of the customer table: new customers appear, others change or drop out.
USER_SNAPSHOT = """
SELECT CAST(c_custkey AS STRING) AS user_id, CAST(20 + c_custkey % 60 + {age_step} AS INT) AS current_age,
  CAST(65 AS INT) AS retirement_age, CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN c_nationkey % 5 = {moved} THEN c_name || ' Moved {moved}' ELSE c_name || ' Street' END AS address,
  CAST(c_nationkey AS DOUBLE) AS latitude,
  CASE WHEN c_nationkey % 7 = {moved} THEN NULL ELSE CAST(c_nationkey AS DOUBLE) END AS longitude,
  CAST(c_custkey AS DOUBLE) AS per_capita_income, CAST(c_custkey * 2 AS DOUBLE) AS yearly_income,
  c_acctbal AS total_debt, CAST(300 + c_custkey % 500 AS INT) AS credit_score,
  CAST(1 + c_custkey % 6 AS INT) AS num_credit_cards, 'batch_{moved}' AS _batch_id
FROM {customer} WHERE c_mktsegment <> '{missing}'
"""


def user_snapshot_sql(version: int) -> str:
    """Snapshot text with its version filled in; the table name stays open."""
    step = {1: (0, 0, "HOUSEHOLD"), 2: (0, 2, "MACHINERY"), 3: (1, 3, "MACHINERY")}[version]
    values = {"age_step": f"(CASE WHEN c_nationkey % 3 = 1 THEN {step[0]} ELSE 0 END)", "moved": step[1], "missing": step[2]}
    text = USER_SNAPSHOT
    for name, value in values.items():
        text = text.replace("{" + name + "}", str(value))
    return text


def duck(text: str) -> str:
    """The text for DuckDB, where the test tables are views of the same name."""
    for table in TEST_TABLES:
        text = text.replace("{" + table + "}", table)
    return text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    found = spark.read.parquet(f"{folder}/{name}.parquet")
    size_shuffles(spark, files.size(spark, f"{folder}/{name}.parquet"))
    return found


def derive(spark: SparkSession, folder: str, text: str) -> DataFrame:
    used = {t: table(spark, folder, t) for t in TEST_TABLES if "{" + t + "}" in text}
    size_shuffles(spark, sum(files.size(spark, f"{folder}/{t}.parquet") for t in used))
    if "lineitem" in used and len(used) > 1:
        # One row group in the test tables: dealt by the key of the join, so that deriving rows is shared by all cores.
        used["lineitem"] = used["lineitem"].repartition("l_orderkey")
        # They aren't moved again for the few suppliers.
        used.update({t: small_side(used[t], files.size(spark, f"{folder}/{t}.parquet")) for t in used if t not in ("lineitem", "orders")})
    return spark.sql(text, **used)
