"""DuckDB oracle SQL for every registered query.

Each query is a chain of named CTEs over the driver views (``events``, ``customer``) that
restates the operator's contract in plain SQL (window functions, sorts, self-joins): a second,
independent formulation to check the Spark plans against. ``sql(names..., final)`` pulls the
CTEs a query needs, with their dependencies, in order.
"""

from __future__ import annotations

import re

# name -> SQL body. Order of definition is dependency order.
CTES: dict[str, str] = {}


def _cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


_cte("ledger_raw0", r"""
SELECT
  event_id + 1 AS tx_id,
  CASE WHEN event_id % 211 = 5 THEN '0xdead' || CAST(event_id AS VARCHAR)
       ELSE '0x' || sha256('tx-' || CAST(event_id AS VARCHAR)) END AS tx_hash,
  CAST((event_id + 1) // 10 + 1 AS BIGINT) AS block_id,
  CASE WHEN event_id % 7 = 0 THEN ' ' || upper('0x' || md5(CAST(user_id AS VARCHAR))) || chr(9)
       ELSE '0x' || md5(CAST(user_id AS VARCHAR)) END AS sender,
  '0x' || md5(CAST((user_id * 7 + event_id) % 150 AS VARCHAR)) AS receiver,
  CAST(CASE WHEN event_id % 33 = 1 THEN NULL
            WHEN event_id % 97 = 2 THEN -value
            WHEN event_id % 101 = 3 THEN 0.0
            ELSE value END AS DOUBLE) AS amount,
  CAST(round(value * (1 + event_id % 10) / 1000.0, 8) AS DOUBLE) AS fee,
  CASE event_type WHEN 'click' THEN 'TRANSFER' WHEN 'error' THEN 'SMART_CONTRACT'
       WHEN 'purchase' THEN 'MINING_REWARD' WHEN 'signup' THEN 'STAKE' WHEN 'view' THEN 'UNSTAKE' END AS tx_type,
  CASE WHEN event_id % 20 <= 16 THEN 'CONFIRMED' WHEN event_id % 20 <= 18 THEN 'PENDING' ELSE 'FAILED' END AS status,
  CASE WHEN event_id % 223 = 7 THEN NULL ELSE ts END AS "timestamp",
  CASE WHEN (event_id // 3) % 2 = 0 THEN 'mainnet' ELSE 'testnet' END AS network
FROM events""")

_cte("ledger_raw", """
SELECT * FROM ledger_raw0
UNION ALL
SELECT tx_id + 1000000000 AS tx_id, tx_hash, block_id, sender, receiver, amount * 2.0 AS amount, fee,
       tx_type, status, "timestamp", network
FROM ledger_raw0 WHERE tx_id % 50 = 0""")

_cte("ledger_wallets", """
SELECT '0x' || md5(CAST(c_custkey AS VARCHAR)) AS wallet_address,
       c_custkey % 2 = 0 AS kyc_verified,
       (['IN', 'US', 'UK', 'SG', 'AE', 'DE'])[c_nationkey % 6 + 1] AS country,
       CAST(floor((c_acctbal + 1000) / 11) / 100.0 AS DOUBLE) AS risk_score
FROM customer WHERE c_custkey % 10 <> 9""")

_cte("dedup", """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY tx_hash ORDER BY tx_id) AS _rn FROM ledger_raw)
WHERE _rn = 1""")

_cte("med", """
SELECT tx_type,
       (max(CASE WHEN _p = (_n - 1) // 2 THEN amount END) + max(CASE WHEN _p = _n // 2 THEN amount END)) / 2.0
         AS median_amount
FROM (SELECT tx_type, amount,
             row_number() OVER (PARTITION BY tx_type ORDER BY amount) - 1 AS _p,
             count(*) OVER (PARTITION BY tx_type) AS _n
      FROM dedup WHERE amount IS NOT NULL AND NOT isnan(amount) AND tx_type IS NOT NULL)
GROUP BY tx_type""")

_cte("imputed", """
SELECT d.* REPLACE (coalesce(d.amount, m.median_amount) AS amount)
FROM dedup d LEFT JOIN med m ON d.tx_type = m.tx_type""")

_cte("clean", r"""
SELECT * REPLACE (regexp_replace(lower(sender), '^\s+|\s+$', '', 'g') AS sender,
                  regexp_replace(lower(receiver), '^\s+|\s+$', '', 'g') AS receiver)
FROM imputed WHERE amount > 0""")

_cte("enriched", """
SELECT c.*, w.kyc_verified, w.country, w.risk_score
FROM clean c LEFT JOIN ledger_wallets w ON c.sender = w.wallet_address""")

_cte("features", """
SELECT *,
       amount * 45000.0 AS amount_usd,
       round_even(fee / amount * 100.0, 4) AS fee_pct,
       CAST(amount > 1.0 AS INTEGER) AS is_large_tx,
       CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
       CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
       ln(1 + amount) AS amount_log
FROM enriched""")

_cte("rules", """
SELECT *,
       coalesce(amount > 0, false) AS _r1,
       coalesce(sender <> receiver, true) AS _r2,
       coalesce(length(tx_hash) = 66, false) AS _r3,
       "timestamp" IS NOT NULL AS _r4
FROM features""")

_cte("valid0", """
SELECT * EXCLUDE (_r1, _r2, _r3, _r4) FROM rules WHERE _r1 AND _r2 AND _r3 AND _r4""")

_cte("invalid", """
SELECT * EXCLUDE (_r1, _r2, _r3, _r4),
       concat_ws(',', CASE WHEN NOT _r1 THEN 'amount_positive' END,
                      CASE WHEN NOT _r2 THEN 'sender_not_receiver' END,
                      CASE WHEN NOT _r3 THEN 'hash_length' END,
                      CASE WHEN NOT _r4 THEN 'timestamp_present' END) AS failed_rules
FROM rules WHERE NOT (_r1 AND _r2 AND _r3 AND _r4)""")

_cte("gstats", """
SELECT min(amount) AS _mn, max(amount) AS _mx, avg(amount) AS _mu, stddev_samp(amount) AS _sd FROM valid0""")

_cte("validated", """
SELECT v.*,
       CASE WHEN _mx = _mn THEN NULL ELSE (amount - _mn) / (_mx - _mn) END AS amount_normalized,
       CASE WHEN _sd IS NULL OR _sd = 0 THEN NULL ELSE (amount - _mu) / _sd END AS amount_zscore,
       CAST(coalesce(abs(CASE WHEN _sd IS NULL OR _sd = 0 THEN NULL ELSE (amount - _mu) / _sd END) > 3.5, false)
            AS INTEGER) AS is_anomaly
FROM valid0 v CROSS JOIN gstats""")

_cte("wallet_stats", """
SELECT sender AS wallet_address,
       CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) AS total_sent,
       CAST(sum(CAST(amount AS DECIMAL(18,8))) AS DOUBLE) / count(amount) AS avg_tx_amount,
       count(tx_id) AS tx_count,
       CAST(sum(CAST(fee AS DECIMAL(18,8))) AS DOUBLE) AS total_fees_paid,
       CAST(count_if(status = 'FAILED') AS BIGINT) AS failed_tx_count,
       count(DISTINCT receiver) AS distinct_receivers,
       round_even(CAST(count_if(status = 'FAILED') AS DOUBLE) / count(tx_id), 4) AS failed_rate
FROM validated WHERE sender IS NOT NULL GROUP BY sender""")

# ---- star schema -----------------------------------------------------------------------------

_cte("dd_bounds", """
SELECT CAST(min(CAST("timestamp" AS DATE)) AS TIMESTAMP) AS _lo,
       CAST(max(CAST("timestamp" AS DATE)) AS TIMESTAMP) AS _hi FROM validated""")

_cte("dim_date", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
       CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS SMALLINT) AS week, CAST(isodow(d) - 1 AS SMALLINT) AS day_of_week,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(_lo, _hi, INTERVAL 1 DAY)) AS DATE) AS d FROM dd_bounds
      WHERE _lo IS NOT NULL)""")

_cte("wallet_seen", """
SELECT wallet_address, min("timestamp") AS first_seen FROM (
  SELECT sender AS wallet_address, "timestamp" FROM validated
  UNION ALL SELECT receiver AS wallet_address, "timestamp" FROM validated)
WHERE wallet_address IS NOT NULL GROUP BY wallet_address""")

_cte("dim_wallet", """
SELECT row_number() OVER (ORDER BY s.wallet_address) AS wallet_key, s.wallet_address,
       w.kyc_verified, w.country AS country_code, CAST(w.risk_score AS DECIMAL(5,2)) AS risk_score, s.first_seen
FROM wallet_seen s LEFT JOIN ledger_wallets w ON s.wallet_address = w.wallet_address""")

_cte("dim_tx_type", """
SELECT CAST(row_number() OVER (ORDER BY tx_type) AS INTEGER) AS tx_type_key, tx_type,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS description
FROM (SELECT DISTINCT tx_type FROM validated WHERE tx_type IS NOT NULL)""")

_cte("dim_network", """
SELECT CAST(row_number() OVER (ORDER BY network) AS INTEGER) AS network_key, network,
       CAST(NULL AS INTEGER) AS chain_id, CAST(NULL AS VARCHAR) AS description
FROM (SELECT DISTINCT network FROM validated WHERE network IS NOT NULL)""")

_cte("fact", """
SELECT CAST(v.tx_id AS BIGINT) AS fact_id, v.tx_id, v.tx_hash, dd.date_key,
       s.wallet_key AS sender_key, r.wallet_key AS receiver_key, t.tx_type_key, n.network_key,
       CAST(v.block_id AS BIGINT) AS block_id,
       CAST(v.amount AS DECIMAL(18,8)) AS amount, CAST(v.fee AS DECIMAL(18,8)) AS fee,
       CAST(v.amount * 45000.0 AS DECIMAL(18,2)) AS amount_usd,
       CAST(coalesce(v.is_anomaly, 0) AS SMALLINT) AS is_anomaly, v.status
FROM validated v
LEFT JOIN dim_date dd ON CAST(v."timestamp" AS DATE) = dd.full_date
LEFT JOIN dim_wallet s ON v.sender = s.wallet_address
LEFT JOIN dim_wallet r ON v.receiver = r.wallet_address
LEFT JOIN dim_tx_type t ON v.tx_type = t.tx_type
LEFT JOIN dim_network n ON v.network = n.network""")

_cte("wallets_3nf", """
SELECT wallet_key AS wallet_id, wallet_address, coalesce(kyc_verified, false) AS kyc_verified, country_code,
       coalesce(risk_score, CAST(0 AS DECIMAL(5,2))) AS risk_score, first_seen AS created_at
FROM dim_wallet""")

_cte("blocks_3nf", """
SELECT CAST(block_id AS BIGINT) AS block_id,
       '0x' || sha256('block-' || CAST(block_id AS VARCHAR)) AS block_hash,
       CAST(NULL AS VARCHAR) AS miner_address, CAST(0 AS DECIMAL(18,8)) AS reward,
       count(*) AS tx_count, min("timestamp") AS created_at
FROM validated WHERE block_id IS NOT NULL GROUP BY block_id""")

_cte("transactions_3nf", """
SELECT v.tx_id, v.tx_hash, CAST(v.block_id AS BIGINT) AS block_id, s.wallet_id AS sender_id,
       r.wallet_id AS receiver_id, CAST(v.amount AS DECIMAL(18,8)) AS amount,
       coalesce(CAST(v.fee AS DECIMAL(18,8)), CAST(0 AS DECIMAL(18,8))) AS fee,
       coalesce(v.tx_type, 'TRANSFER') AS tx_type, coalesce(v.status, 'PENDING') AS status,
       coalesce(v.network, 'mainnet') AS network, v."timestamp" AS created_at
FROM validated v
LEFT JOIN wallets_3nf s ON v.sender = s.wallet_address
LEFT JOIN wallets_3nf r ON v.receiver = r.wallet_address""")

# ---- loads: the earlier half of the days, the later half, and every tenth transaction of the earlier half late --

_cte("load_of", """
SELECT tx_id, sender, receiver,
       CASE WHEN day > mid THEN 'second' WHEN tx_id % 10 = 0 THEN 'late' ELSE 'first' END AS load_id,
       CASE WHEN day > mid THEN 2 WHEN tx_id % 10 = 0 THEN 3 ELSE 1 END AS load_no
FROM (SELECT tx_id, sender, receiver, CAST("timestamp" AS DATE) AS day FROM validated)
CROSS JOIN (SELECT min(CAST("timestamp" AS DATE)) + CAST((max(CAST("timestamp" AS DATE)) - min(CAST("timestamp" AS DATE))) // 2 AS INTEGER) AS mid
            FROM validated)""")

_cte("lasting_wallet", """
SELECT row_number() OVER (ORDER BY a.load_no, a.wallet_address) AS wallet_key, a.wallet_address, w.country AS country_code
FROM (SELECT wallet_address, min(load_no) AS load_no
      FROM (SELECT sender AS wallet_address, load_no FROM load_of UNION ALL SELECT receiver AS wallet_address, load_no FROM load_of)
      WHERE wallet_address IS NOT NULL GROUP BY wallet_address) a
LEFT JOIN ledger_wallets w ON w.wallet_address = a.wallet_address""")

# ---- stream events ---------------------------------------------------------------------------

_cte("stream_events", """
SELECT tx_hash, sender, receiver, amount, CAST(round(amount * 0.005, 8) AS DOUBLE) AS fee,
       'PENDING' AS status, network, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
FROM ledger_raw0""")

_cte("stream_enriched", """
SELECT tx_hash, _amt AS amount,
       CASE WHEN _amt = 0 THEN 'INVALID' ELSE status END AS status,
       CASE WHEN _amt <> 0 AND _amt > 50 THEN 'HIGH_VALUE' END AS flag,
       network
FROM (SELECT *, greatest(coalesce(CASE WHEN isnan(TRY_CAST(CAST(amount AS VARCHAR) AS DOUBLE)) THEN NULL
                                       ELSE TRY_CAST(CAST(amount AS VARCHAR) AS DOUBLE) END, 0.0), 0.0) AS _amt
      FROM stream_events)""")


_NAME = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(name: str) -> list[str]:
    body = CTES[name]
    return [t for t in dict.fromkeys(_NAME.findall(body)) if t in CTES and t != name]


def sql(final: str) -> str:
    """``WITH <needed ctes> <final>``: CTEs referenced by ``final`` (transitively), in order."""
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in _deps(n):
            visit(d)

    for t in dict.fromkeys(_NAME.findall(final)):
        if t in CTES:
            visit(t)
    ordered = [n for n in CTES if n in need]
    if not ordered:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in ordered) + "\n" + final.strip()
