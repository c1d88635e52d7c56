"""DuckDB SQL, written independently of the operators it checks.

``PARTS`` are named sub-queries; ``query`` puts those a text needs in front of it.
"""

from __future__ import annotations

import re

from cardmill.queries import inputs

# Fixed values in this text: placeholders, currency marks and words, format names, notes.
PARSE_MONEY = r"""
SELECT * EXCLUDE (t, cur, body, neg, d, nd, nc, numtext, ok, vnd, three, unclear),
  CASE WHEN ok AND NOT unclear THEN CASE WHEN neg THEN -TRY_CAST(numtext AS DECIMAL(18,2)) ELSE TRY_CAST(numtext AS DECIMAL(18,2)) END END AS amount,
  cur AS amount_currency,
  CASE WHEN d IS NULL THEN 'INVALID' WHEN unclear THEN 'AMBIGUOUS' WHEN NOT ok THEN 'INVALID'
       WHEN nd = 0 AND nc = 0 THEN 'CLEAN'
       WHEN nd > 0 AND nc > 0 THEN CASE WHEN usual THEN 'US' ELSE 'EU' END
       WHEN nd > 1 THEN 'VN' WHEN nd = 1 THEN CASE WHEN three THEN 'VN' ELSE 'CLEAN' END
       WHEN nc > 1 THEN 'US' ELSE CASE WHEN three THEN 'VN' ELSE 'EU' END END AS amount_format,
  CASE WHEN amount_raw IS NULL THEN 'null input' WHEN d IS NULL THEN 'empty or placeholder'
       WHEN unclear THEN 'ambiguous: ''' || d || ''' could be ' || replace(replace(d, '.', ''), ',', '') || ' or ' || replace(d, ',', '.')
       WHEN NOT ok THEN CASE WHEN nd > 0 AND nc > 0 THEN CASE WHEN usual THEN 'US' ELSE 'EU' END || ' parse failed: '
            WHEN nd > 1 THEN 'multi-dot parse failed: ' WHEN nc > 1 THEN 'multi-comma parse failed: ' ELSE 'cannot parse: ' END || d
       WHEN nd = 0 AND nc = 0 THEN 'clean numeric'
       WHEN nd > 0 AND nc > 0 THEN CASE WHEN usual THEN 'US format' ELSE 'EU format' END
       WHEN nd > 1 THEN 'multiple dots = thousand sep'
       WHEN nd = 1 THEN CASE WHEN three THEN 'VND → dot is thousand sep' ELSE 'decimal number' END
       WHEN nc > 1 THEN 'multiple commas = thousand sep'
       ELSE CASE WHEN three THEN 'VND → comma is thousand sep' ELSE 'EU decimal comma' END END AS amount_parse_note
FROM (
  SELECT *, coalesce(regexp_full_match(numtext, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?'), false) AS ok,
    three AND NOT (vnd AND coalesce(regexp_full_match(numtext, '[+-]?\d+'), false)) AS unclear
  FROM (
    SELECT *,
      CASE WHEN nd > 0 AND nc > 0 THEN CASE WHEN usual THEN replace(d, ',', '') ELSE replace(replace(d, '.', ''), ',', '.') END
           WHEN nd > 1 OR (nd = 1 AND three) THEN replace(d, '.', '')
           WHEN nc > 1 OR (nc = 1 AND three) THEN replace(d, ',', '')
           ELSE replace(d, ',', '.') END AS numtext
    FROM (
      SELECT *, coalesce(cur = 'VND', false) AS vnd,
        instr(reverse(d), '.') < instr(reverse(d), ',') AS usual,
        (nd = 1 AND nc = 0 AND length(d) - instr(d, '.') = 3) OR (nc = 1 AND nd = 0 AND length(d) - instr(d, ',') = 3) AS three
      FROM (
        SELECT *, length(d) - length(replace(d, '.', '')) AS nd, length(d) - length(replace(d, ',', '')) AS nc
        FROM (
          SELECT *, body LIKE '(%)' OR body LIKE '-%' AS neg,
            replace(CASE WHEN body LIKE '(%)' THEN body[2:-2] WHEN body LIKE '-%' THEN trim(body[2:]) ELSE body END, ' ', '') AS d
          FROM (
            SELECT *, CASE WHEN t IS NULL OR t IN ('', '-', 'N/A', 'n/a', 'NULL', 'null', 'none') THEN NULL
                WHEN t[1] IN ('$', '€', '£', '₫', '¥') THEN trim(t[2:])
                ELSE trim(regexp_replace(t, '\b(USD|EUR|GBP|VND|JPY|SGD|THB)\b', '', 'gi')) END AS body
            FROM (
              SELECT * EXCLUDE (amount), amount AS amount_raw, trim(amount) AS t,
                CASE WHEN trim(amount) IN ('', '-', 'N/A', 'n/a', 'NULL', 'null', 'none') THEN NULL
                  ELSE CASE trim(amount)[1] WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' WHEN '₫' THEN 'VND'
                    WHEN '¥' THEN 'JPY'
                    ELSE upper(nullif(regexp_extract(trim(amount), '\b(USD|EUR|GBP|VND|JPY|SGD|THB)\b', 1, 'i'), '')) END END AS cur
              FROM {source}
            )
          )
        )
      )
    )
  )
)
"""

# Flag column and the text it stands for.
_ERRORS = {
    "error_bad_pin": "Bad PIN",
    "error_bad_cvv": "Bad CVV",
    "error_bad_card_number": "Bad Card Number",
    "error_bad_expiration": "Bad Expiration",
    "error_bad_zipcode": "Bad Zipcode",
    "error_insufficient_balance": "Insufficient Balance",
    "error_technical_glitch": "Technical Glitch",
}
_FOUND = {flag: f"coalesce(contains(errors, '{text}'), false)" for flag, text in _ERRORS.items()}
ERROR_FLAGS = ", ".join([*(f"{found} AS {flag}" for flag, found in _FOUND.items()), f"({' OR '.join(_FOUND.values())}) AS has_error"])

# Two-letter codes of the 50 US states.
US_STATES = (
    "'AL','AK','AZ','AR','CA','CO','CT','DE','FL','GA','HI','ID','IL','IN','IA','KS','KY','LA','ME','MD','MA','MI','MN',"
    "'MS','MO','MT','NE','NV','NH','NJ','NM','NY','NC','ND','OH','OK','OR','PA','RI','SC','SD','TN','TX','UT','VT','VA',"
    "'WA','WV','WI','WY'"
)

ZIP = (
    "CASE WHEN TRY_CAST(zip AS DOUBLE) IS NULL THEN zip WHEN TRY_CAST(zip AS DOUBLE) <= -1 "
    "THEN '-' || CASE WHEN trunc(-TRY_CAST(zip AS DOUBLE)) > 9999 THEN CAST(CAST(trunc(-TRY_CAST(zip AS DOUBLE)) AS BIGINT) AS STRING) "
    "ELSE lpad(CAST(CAST(trunc(-TRY_CAST(zip AS DOUBLE)) AS BIGINT) AS STRING), 4, '0') END "
    "WHEN TRY_CAST(zip AS DOUBLE) >= 100000 THEN CAST(CAST(trunc(TRY_CAST(zip AS DOUBLE)) AS BIGINT) AS STRING) "
    "ELSE lpad(CAST(CAST(trunc(TRY_CAST(zip AS DOUBLE)) AS BIGINT) AS STRING), 5, '0') END"
)

CHIP = (
    "CAST(CASE use_chip WHEN 'Swipe Transaction' THEN 0 WHEN 'Chip Transaction' THEN 1 "
    "WHEN 'Online Transaction' THEN 2 END AS INT)"
)

TIER = "CASE WHEN {r} >= 0.10 THEN 'CRITICAL' WHEN {r} >= 0.05 THEN 'HIGH' WHEN {r} >= 0.02 THEN 'MEDIUM' ELSE 'LOW' END"

MASK = (
    "CASE WHEN card_number IS NULL OR card_number = '' THEN NULL ELSE 'XXXX-XXXX-XXXX-' || "
    "lpad(right(regexp_replace(card_number, '[^0-9]', '', 'g'), 4), 4, '0') END"
)

BAND = (
    "CASE WHEN {s} IS NULL THEN NULL WHEN {s} < 300 OR {s} > 850 THEN 'INVALID' WHEN {s} < 580 THEN 'POOR' "
    "WHEN {s} < 670 THEN 'FAIR' WHEN {s} < 740 THEN 'GOOD' WHEN {s} < 800 THEN 'VERY_GOOD' ELSE 'EXCEPTIONAL' END"
)

GROUP = (
    "CASE WHEN {a} IS NULL THEN NULL WHEN {a} < 18 THEN 'TEEN' WHEN {a} <= 25 THEN 'YOUNG_ADULT' "
    "WHEN {a} <= 40 THEN 'ADULT' WHEN {a} <= 60 THEN 'MIDDLE_AGED' ELSE 'SENIOR' END"
)

ACCOUNT_AGE = (
    "CAST((2024 - TRY_CAST(split_part(acct_open_date, '/', 2) AS INT)) * 12 + "
    "(1 - TRY_CAST(split_part(acct_open_date, '/', 1) AS INT)) AS INT)"
)


def money(column: str) -> str:
    return f"TRY_CAST(replace(replace({column}, '$', ''), ',', '') AS DOUBLE)"


PARTS = {
    "q_raw_txn": inputs.RAW_TRANSACTIONS,
    "q_raw_users": inputs.RAW_USERS,
    "q_raw_cards": inputs.RAW_CARDS,
    "q_raw_mcc": inputs.RAW_MCC_CODES,
    "q_raw_label": inputs.RAW_LABELS,
    "q_ev": inputs.EVENT_TRANSACTIONS,
    "q_evm": inputs.EVENT_PAYMENTS,
    "q_versions": inputs.OVERLAPPING_VERSIONS,
    "q_lookups": inputs.LOOKUPS,
    "q_evs": "SELECT *, epoch_us(transaction_date) // 1000000 AS sec FROM q_ev",
    "q_snap1": inputs.user_snapshot_sql(1),
    "q_snap2": inputs.user_snapshot_sql(2),
    "q_snap3": inputs.user_snapshot_sql(3),
    "q_one_txn": """
        SELECT * EXCLUDE (rk) FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC NULLS LAST, _source_file) AS rk FROM q_raw_txn
        ) WHERE rk = 1 OR id IS NULL""",
    "q_parsed_txn": PARSE_MONEY.replace("{source}", "q_one_txn"),
    "q_cleaned": f"""
        SELECT * EXCLUDE (d), CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
          d AS transaction_date,
          transaction_id IS NOT NULL AND d IS NOT NULL AND user_id IS NOT NULL AND amount IS NOT NULL
            AND amount_format NOT IN ('AMBIGUOUS', 'INVALID') AS is_valid
        FROM (
          SELECT id AS transaction_id, client_id AS user_id, card_id, amount_raw, amount, amount_currency, amount_format,
            amount_parse_note, coalesce(amount < 0, false) AS is_refund, {CHIP} AS use_chip, use_chip AS use_chip_raw,
            merchant_state IS NULL AND upper(merchant_city) = 'ONLINE' AS is_online_transaction, merchant_id, merchant_city,
            CASE WHEN merchant_state IS NULL AND upper(merchant_city) = 'ONLINE' THEN 'ONLINE' ELSE merchant_state END AS merchant_state,
            CASE WHEN merchant_state IS NULL AND upper(merchant_city) = 'ONLINE' THEN 'ONLINE' ELSE {ZIP} END AS zip,
            TRY_CAST(mcc AS INT) AS mcc, {ERROR_FLAGS}, _loaded_at, _ingested_at, _source_file, _batch_id,
            TRY_CAST(date AS TIMESTAMP) AS d
          FROM q_parsed_txn
        )""",
    "q_mcc": """
        SELECT TRY_CAST(mcc_code AS INT) AS mcc, min(mcc_code) AS mcc_code, min(description) AS mcc_description
        FROM q_raw_mcc WHERE TRY_CAST(mcc_code AS INT) IS NOT NULL GROUP BY 1""",
    "q_one_card": """
        SELECT * EXCLUDE (rk) FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC NULLS LAST, _batch_id) AS rk FROM q_raw_cards
        ) WHERE rk = 1""",
    "q_cards": f"""
        SELECT id AS card_id, client_id AS user_id, card_brand, card_type, {MASK} AS card_number_masked,
          TRY_CAST(split_part(expires, '/', 1) AS INT) AS expires_month,
          TRY_CAST(nullif(split_part(expires, '/', 2), '') AS INT) AS expires_year,
          upper(has_chip) = 'YES' AS has_chip, TRY_CAST(num_cards_issued AS INT) AS num_cards_issued,
          {money('credit_limit')} AS credit_limit, acct_open_date, {ACCOUNT_AGE} AS account_age_months,
          TRY_CAST(year_pin_last_changed AS INT) AS year_pin_last_changed,
          upper(card_on_dark_web) = 'YES' AS card_on_dark_web, id IS NOT NULL AS is_valid,
          _ingested_at, _source_file, _batch_id, lower(card_brand) AS card_brand_part,
          TRY_CAST(nullif(split_part(expires, '/', 2), '') AS INT) AS expires_year_part
        FROM q_one_card""",
    "q_one_user": """
        SELECT * EXCLUDE (rk) FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY _loaded_at DESC NULLS LAST, _batch_id) AS rk FROM q_raw_users
        ) WHERE rk = 1""",
    "q_users": f"""
        SELECT id AS user_id, TRY_CAST(current_age AS INT) AS current_age,
          {GROUP.format(a='TRY_CAST(current_age AS INT)')} AS age_group,
          TRY_CAST(retirement_age AS INT) AS retirement_age, TRY_CAST(birth_year AS INT) AS birth_year,
          TRY_CAST(birth_month AS INT) AS birth_month, gender, address, TRY_CAST(latitude AS DOUBLE) AS latitude,
          TRY_CAST(longitude AS DOUBLE) AS longitude, {money('per_capita_income')} AS per_capita_income,
          {money('yearly_income')} AS yearly_income, {money('total_debt')} AS total_debt,
          TRY_CAST(credit_score AS INT) AS credit_score, {BAND.format(s='TRY_CAST(credit_score AS INT)')} AS credit_score_band,
          coalesce(TRY_CAST(credit_score AS INT) NOT BETWEEN 300 AND 850, false) AS is_invalid_credit_score,
          TRY_CAST(num_credit_cards AS INT) AS num_credit_cards, id IS NOT NULL AS is_valid,
          _ingested_at, _source_file, _batch_id, TRY_CAST(birth_year AS INT) AS created_year,
          TRY_CAST(birth_month AS INT) AS created_month
        FROM q_one_user""",
    "q_label": """
        SELECT transaction_id, bool_or(upper(is_fraud) = 'YES') AS is_fraud FROM q_raw_label GROUP BY transaction_id""",
    "q_enriched": """
        SELECT c.*, CASE WHEN c.mcc IS NULL THEN NULL ELSE coalesce(m.mcc_description, 'UNKNOWN') END AS mcc_description,
          k.card_brand, k.card_type, k.card_number_masked, k.card_on_dark_web, f.is_fraud
        FROM q_cleaned c LEFT JOIN q_mcc m ON c.mcc = m.mcc LEFT JOIN q_cards k ON c.card_id = k.card_id
          LEFT JOIN q_label f ON c.transaction_id = f.transaction_id""",
    "q_valid_txn": "SELECT * FROM q_enriched WHERE is_valid",
    "q_txn_features": "{features:q_valid_txn}",
    "q_merchants": f"""
        SELECT *, {TIER.format(r='fraud_rate')} AS risk_tier FROM (
          SELECT merchant_id, max(merchant_city) AS merchant_city, max(merchant_state) AS merchant_state, max(mcc) AS mcc,
            max(mcc_description) AS mcc_description, count(*) AS total_txn_count,
            count(*) FILTER (WHERE is_fraud) AS fraud_txn_count,
            round(CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) / count(*), 4) AS fraud_rate,
            CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount
          FROM q_valid_txn WHERE merchant_id IS NOT NULL GROUP BY merchant_id
        )""",
    "q_dim1": """
        SELECT *, TIMESTAMP '1996-01-01 00:00:00' AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to,
          true AS is_current FROM q_snap1""",
    "q_dim2": "{merge:q_dim1:q_snap2:1998-01-01}",
    "q_dim3": "{merge:q_dim2:q_snap3:2000-01-01}",
    "q_quarantine": """
        SELECT transaction_id, amount_raw, amount_format, amount_parse_note,
          CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID'
               WHEN transaction_date IS NULL THEN 'MISSING_TRANSACTION_DATE' WHEN user_id IS NULL THEN 'MISSING_USER_ID'
               WHEN amount_format IN ('AMBIGUOUS', 'INVALID') THEN amount_format ELSE 'MISSING_AMOUNT' END AS quarantine_reason,
          CAST(NULL AS STRING) AS resolved_by, CAST(NULL AS TIMESTAMP) AS resolved_at, false AS is_resolved,
          _batch_id, year, month, day
        FROM q_cleaned WHERE NOT is_valid""",
}


def features_sql(source: str, carry: str = "") -> str:
    """Feature table of a relation that has user, id, time and amount.

    ``carry`` is the name of a relation with earlier totals per user.
    """
    total = "sum(amount) OVER run" + (f" + coalesce((SELECT amount_sum FROM {carry} o WHERE o.user_id = s.user_id), 0)" if carry else "")
    count = "count(amount) OVER run" + (f" + coalesce((SELECT amount_count FROM {carry} o WHERE o.user_id = s.user_id), 0)" if carry else "")
    return f"""
SELECT transaction_id, user_id, txn_count_last_1h, txn_count_last_24h, txn_count_last_7d, amount_sum_last_1h,
  amount_sum_last_24h, CASE WHEN av > 0 THEN CAST(amount AS DOUBLE) / av END AS amount_vs_user_avg_ratio,
  hour(transaction_date) BETWEEN 0 AND 5 AS is_night_txn, dayofweek(transaction_date) IN (0, 6) AS is_weekend,
  merchant_state NOT IN ({US_STATES}) AS is_foreign_merchant, card_on_dark_web, is_fraud,
  CAST(NULL AS DOUBLE) AS risk_score, _batch_id, year, month, day
FROM (
  SELECT *, CAST({total} AS DOUBLE) / ({count}) AS av,
    count(transaction_id) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS txn_count_last_1h,
    count(transaction_id) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS txn_count_last_24h,
    count(transaction_id) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS txn_count_last_7d,
    CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS DOUBLE) AS amount_sum_last_1h,
    CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS DOUBLE) AS amount_sum_last_24h
  FROM (SELECT *, epoch_us(transaction_date) // 1000000 AS sec FROM {source}) s
  WINDOW run AS (PARTITION BY user_id ORDER BY sec, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


# Columns whose change opens a new version.
_TRACKED = (
    "address", "latitude", "longitude", "yearly_income", "total_debt", "credit_score", "per_capita_income", "current_age", "num_credit_cards",
)


def merge_sql(dim: str, snapshot: str, day: str) -> str:
    """Type 2 merge as four pieces: history, open rows that stay, rows that close, rows that open."""
    changed = " OR ".join(f"d.{c} IS DISTINCT FROM s.{c}" for c in _TRACKED)
    at = f"TIMESTAMP '{day} 00:00:00'"
    return f"""
SELECT * FROM {dim} WHERE NOT is_current
UNION ALL BY NAME
SELECT d.* FROM {dim} d LEFT JOIN {snapshot} s ON d.user_id = s.user_id
WHERE d.is_current AND (s.user_id IS NULL OR NOT ({changed}))
UNION ALL BY NAME
SELECT d.* REPLACE ({at} AS valid_to, false AS is_current) FROM {dim} d JOIN {snapshot} s ON d.user_id = s.user_id
WHERE d.is_current AND ({changed})
UNION ALL BY NAME
SELECT s.*, {at} AS valid_from, TIMESTAMP '9999-12-31 00:00:00' AS valid_to, true AS is_current
FROM {snapshot} s LEFT JOIN (SELECT * FROM {dim} WHERE is_current) d ON d.user_id = s.user_id
WHERE d.user_id IS NULL OR ({changed})"""


def _text(name: str) -> str:
    text = PARTS[name]
    if text.startswith("{features:"):
        return features_sql(text[1:-1].split(":")[1])
    if text.startswith("{merge:"):
        return merge_sql(*text[1:-1].split(":")[1:])
    return text


def query(select: str) -> str:
    """``select`` with the sub-queries it mentions, directly or through others."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in PARTS:
            if name not in order and re.search(rf"\b{name}\b", text):
                need(_text(name))
                if name not in order:
                    order.append(name)

    need(select)
    head = ", ".join(f"{name} AS ({_text(name)})" for name in order)
    return inputs.duck(f"WITH {head} {select}" if head else select)
