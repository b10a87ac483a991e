"""SQL text of the derived views, for the SQL twins."""

WORDS = r"regexp_extract_all(lower(text), '[\pL\pN_\pM]{2,}')"
TXN0 = """txn0 AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS transaction_id, ts, user_id,
    'cust_' || CAST(user_id AS VARCHAR) AS customer_id,
    'merch_' || CAST(event_id % 50 AS VARCHAR) AS merchant_id,
    event_type AS merchant_category,
    CASE event_id % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'mobile' ELSE 'nfc' END AS payment_method,
    CAST(round(value * 100) AS BIGINT) * 100 AS amount,
    CASE WHEN event_id % 20 = 0 THEN 'declined' ELSE 'approved' END AS status,
    CASE event_id % 3 WHEN 0 THEN 'flat' WHEN 1 THEN 'progressive' ELSE 'tiered' END AS commission_type,
    CASE user_id % 3 WHEN 0 THEN 'individual' WHEN 1 THEN 'CIP' ELSE 'business' END AS customer_type,
    CASE WHEN event_id % 50 = 0 THEN 5 ELSE 1 + event_id % 3 END AS risk_level,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""
TXN = TXN0 + """, txn AS (
  SELECT *, amount * 2 // 100 AS commission_amount, amount * 9 // 100 AS vat_amount,
    amount + amount * 2 // 100 + amount * 9 // 100 AS total_amount,
    CAST(35.7219 AS DOUBLE) + ((k % 11) - 5) * CAST(0.2 AS DOUBLE) AS lat,
    CAST(51.3347 AS DOUBLE) + ((k % 7) - 3) * CAST(0.2 AS DOUBLE) AS lng
  FROM txn0)"""
GAPS = """gaps AS (
  SELECT event_id, ts, user_id, CASE WHEN event_id % 17 <> 0 THEN event_type END AS event_type,
    CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events)"""
BOXES = """boxes AS (
  SELECT 'img_' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS filename,
    lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '_' || lpad(CAST(l_partkey AS VARCHAR), 8, '0') || '_' ||
      lpad(CAST(l_suppkey AS VARCHAR), 8, '0') || '_' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS box_id,
    640 AS width, 480 AS height,
    CASE WHEN z THEN 0 ELSE l_partkey % 500 END AS xmin,
    CASE WHEN z THEN 0 ELSE l_suppkey % 400 END AS ymin,
    CASE WHEN z THEN 0 ELSE l_partkey % 500 + 20 + 2 * CAST(l_quantity AS BIGINT) END AS xmax,
    CASE WHEN z THEN 0 ELSE l_suppkey % 400 + 10 + CAST(l_quantity AS BIGINT) END AS ymax,
    l_linenumber AS shift
  FROM (SELECT *, (l_orderkey * 7 + l_linenumber) % 50 = 0 AS z FROM lineitem))"""
PRED = """pred AS (
  SELECT filename, box_id AS pred_id, xmin + shift AS xmin, ymin + 1 AS ymin,
    xmax + shift AS xmax, ymax + 1 AS ymax FROM boxes)"""
RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, avg(1 + CAST(l_quantity AS INTEGER) % 5) AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
EDGES = """edges AS (
  SELECT src, dst, max(weight) AS weight FROM (
    SELECT c_custkey AS src, (c_custkey * 7 + 3) % (SELECT count(*) FROM customer) AS dst, 1 + c_custkey % 3 AS weight
    FROM customer WHERE c_custkey % 10 <> 9
    UNION ALL
    SELECT c_custkey, (c_custkey * 13 + 5) % (SELECT count(*) FROM customer), 1 + c_custkey % 3
    FROM customer WHERE c_custkey % 10 <> 9 AND c_custkey % 2 = 0)
  WHERE src <> dst GROUP BY 1, 2)"""
OHLCV = """ohlcv AS (
  SELECT CAST(o_orderdate AS DATE) AS day, min_by(o_totalprice, o_orderkey) AS "open", max(o_totalprice) AS high,
    min(o_totalprice) AS low, max_by(o_totalprice, o_orderkey) AS "close", sum(o_totalprice) AS volume
  FROM orders GROUP BY 1)"""
POLLS = """polls AS (
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS pollster, count(*) AS n,
    100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'F') / count(*) AS pct_f,
    100.0::DOUBLE * count(*) FILTER (o_orderstatus = 'O') / count(*) AS pct_o
  FROM orders GROUP BY 1, 2)"""
QA = """qa AS (
  SELECT q.conv_id, q.question, a.turn AS answer_turn, a.text AS answer
  FROM (SELECT conv_id, min_by(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY 1) q
  LEFT JOIN (SELECT * FROM conversations WHERE role = 'assistant') a ON a.conv_id = q.conv_id)"""
PROBS = """expo AS (
  SELECT vec_id, label, exp(embedding[1]::DOUBLE) AS a, exp(embedding[2]::DOUBLE) AS b,
    exp(embedding[3]::DOUBLE) AS c FROM embeddings),
probs AS (SELECT vec_id, label, a / (a + b + c) AS p1, b / (a + b + c) AS p2, c / (a + b + c) AS p3 FROM expo)"""


def with_views(*views: str) -> str:
    return "WITH " + ", ".join(views) + " "


def lcs_sql(pairs: str) -> str:
    """CTE ``lcs`` (a, b, n) over the CTE ``pairs`` (a, b): length of the longest common subsequence, one letter of ``a`` per step."""
    return f"""lcs_rows AS (SELECT a, b, 0 AS i, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) AS row FROM {pairs} UNION ALL
SELECT a, b, i + 1, list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda k: list_max(list_transform(range(1, k + 1), lambda j:
  greatest(row[j + 1], CASE WHEN substr(b, j, 1) = substr(a, CAST(i + 1 AS BIGINT), 1) THEN row[j] + 1 ELSE 0 END))))) FROM lcs_rows WHERE i < length(a)),
lcs AS (SELECT a, b, row[length(b) + 1] AS n FROM lcs_rows WHERE i = length(a)) """


def normal_upper_sql(z: str) -> str:
    """Upper tail of the standard normal distribution at ``z``, by Simpson's rule."""
    x = f"least(abs({z}), 9.0::DOUBLE)"
    area = f"list_sum(list_transform(range(0, 2001), lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(i * {x} / 2000, 2) / 2)))"
    return f"(0.5::DOUBLE - sign({z}) * {area} * {x} / 6000 / sqrt(2 * pi()))"
