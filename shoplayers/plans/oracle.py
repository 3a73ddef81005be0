"""The registered queries as plain SQL for an independent engine.

`sql("SELECT ...", "view", ...)` puts the named views and everything they need in front.
"""

from __future__ import annotations

from shoplayers import constants as K
from shoplayers.sources.views import PHRASES

REFERENCE_DATE = "2024-01-31"
SECOND = 1_000_000_000_000
SPACE = r"[\s\p{Z}\x{85}\x1c-\x1f]"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def pct(part: str, whole: str, digits: int = 2) -> str:
    """100 * part / whole rounded half up, in integer arithmetic."""
    scale = 10**digits
    return (
        f"CAST((2 * {100 * scale} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}"
    )


def mean(total: str, n: str, digits: int) -> str:
    """total / n rounded half up, for whole numbers."""
    scale = 10**digits
    return f"CAST((2 * {scale} * CAST({total} AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / {scale}"


def money_mean(column: str) -> str:
    cents = f"CAST(SUM({column}) * 100 AS HUGEINT)"
    return f"CAST(CAST((2 * {cents} + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100 AS DECIMAL(14,2))"


def strip(column: str) -> str:
    return f"regexp_replace({column}, '^{SPACE}+|{SPACE}+$', '', 'g')"


_TERMS = "|".join(sorted(K.DOMAIN_TERMS, key=len, reverse=True))
_PHRASES = ", ".join(f"'{phrase}'" for phrase in PHRASES)
TOKEN = rf"{_TERMS}|\p{{Han}}{{2}}|(?:[^\P{{L}}\p{{Han}}]|[\p{{N}}_]){{2,}}"


def tokens(column: str) -> str:
    keep = rf"w NOT IN ({quoted(K.STOP_WORDS)}) AND NOT regexp_full_match(w, '\p{{Nd}}+')"
    apart = rf"regexp_replace({column}, '({_TERMS})', chr(1) || '\1' || chr(1), 'g')"
    return f"list_filter(regexp_extract_all({apart}, '{TOKEN}'), lambda w: {keep})"


def band(score: str) -> str:
    return (
        f"CASE WHEN {score} <= {K.NEGATIVE_MAX} THEN '{K.NEGATIVE}' "
        f"WHEN {score} <= {K.NEUTRAL_MAX} THEN '{K.NEUTRAL}' ELSE '{K.POSITIVE}' END"
    )


def _segment_case() -> str:
    parts = []
    for highs, label in K.SEGMENTS.items():
        tests = [f"{d}_score {'>=' if h else '<'} {K.HIGH_SCORE}" for d, h in zip("rfm", highs)]
        parts.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(parts)} END"


def order_case(column: str, order) -> str:
    parts = " ".join(f"WHEN '{v}' THEN {i + 1}" for i, v in enumerate(order))
    return f"CAST(CASE {column} {parts} ELSE 0 END AS INTEGER)"


_SECONDS = "CAST(date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS VARCHAR)"
_COUNTS = ", ".join(f"COUNT(*) FILTER (WHERE behavior = '{b}') AS {b}_cnt" for b in K.BEHAVIOURS)

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "behaviour": (
        (),
        f"""SELECT event_id AS ingest_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS goods_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
        CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav'
             WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior,
        CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 101 = 0 THEN '' WHEN event_id % 103 = 0 THEN NULL
             WHEN event_id % 107 = 0 THEN {_SECONDS} || '.5' WHEN event_id % 109 = 0 THEN '-' || {_SECONDS}
             ELSE {_SECONDS} END AS timestamp,
        CAST(user_id % 2 AS INTEGER) AS sex, CAST(NULL AS VARCHAR) AS address, 'dev' || (user_id % 7) AS device,
        CAST(value AS DECIMAL(12,2)) AS price, CAST(1 + event_id % 3 AS INTEGER) AS amount,
        CAST(NULL AS VARCHAR) AS comment FROM events""",
    ),
    "behaviour_gaps": (
        ("behaviour",),
        """SELECT * REPLACE (CASE WHEN ingest_id % 13 = 0 THEN NULL ELSE sex END AS sex,
        CASE WHEN ingest_id % 17 = 0 THEN NULL ELSE price END AS price,
        CASE WHEN ingest_id % 19 = 0 THEN -1 WHEN ingest_id % 23 = 0 THEN 500 ELSE amount END AS amount)
        FROM behaviour""",
    ),
    "behaviour_twice": (
        ("behaviour",),
        f"""SELECT b.* REPLACE (b.ingest_id + d.delivery * {SECOND} AS ingest_id)
        FROM behaviour b JOIN (VALUES (0), (1)) d(delivery) ON d.delivery = 0 OR b.ingest_id % 50 = 0""",
    ),
    "dwd": (
        ("behaviour",),
        f"""SELECT id, user_id, goods_id, category_id, behavior, event_time, CAST(event_time AS DATE) AS event_date,
        CAST(hour(event_time) AS INTEGER) AS event_hour, sex, address, device, price, amount FROM (
        SELECT ingest_id AS id, *,
        TIMESTAMP '1970-01-01 00:00:00' + to_seconds(TRY_CAST(timestamp AS BIGINT)) AS event_time FROM behaviour
        WHERE regexp_full_match(timestamp, '[0-9]+') AND TRY_CAST(timestamp AS BIGINT) <= {K.MAX_EPOCH_SECOND}
        AND behavior IN ({quoted(K.BEHAVIOURS)}))""",
    ),
    "user_day": (
        ("dwd",),
        f"""SELECT user_id, event_date, {_COUNTS},
        CAST(COALESCE(SUM(CASE WHEN behavior = 'buy' THEN price * amount END), 0) AS DECIMAL(14,2)) AS buy_amount,
        CAST(1 AS INTEGER) AS is_active,
        CAST(MAX(CASE WHEN behavior = 'buy' THEN 1 ELSE 0 END) AS INTEGER) AS is_buyer
        FROM dwd GROUP BY user_id, event_date""",
    ),
    "rfm_raw": (
        ("user_day",),
        f"""SELECT user_id, CAST(date_diff('day', MAX(CASE WHEN is_buyer = 1 THEN event_date END),
        DATE '{REFERENCE_DATE}') AS INTEGER) AS r_days, CAST(SUM(buy_cnt) AS BIGINT) AS f_freq,
        CAST(SUM(buy_amount) AS DECIMAL(14,2)) AS m_amount
        FROM user_day GROUP BY user_id HAVING SUM(buy_cnt) > 0""",
    ),
    "rfm_scores": (
        ("rfm_raw",),
        """SELECT *, CAST(NTILE(4) OVER (ORDER BY r_days DESC, user_id) AS INTEGER) AS r_score,
        CAST(NTILE(4) OVER (ORDER BY f_freq, user_id) AS INTEGER) AS f_score,
        CAST(NTILE(4) OVER (ORDER BY m_amount, user_id) AS INTEGER) AS m_score FROM rfm_raw""",
    ),
    "segments": (("rfm_scores",), f"SELECT *, {_segment_case()} AS user_segment FROM rfm_scores"),
    "profile_raw": (
        (),
        f"""SELECT c_custkey + delivery * {SECOND} AS ingest_id, c_custkey AS user_id,
        CASE WHEN delivery = 1 THEN 'later row' WHEN c_custkey % 7 = 0 THEN chr(12288) || c_mktsegment || '  '
        WHEN c_custkey % 5 = 0 THEN c_mktsegment || ' / x' WHEN c_custkey % 11 = 0 THEN NULL
        ELSE c_mktsegment END AS face
        FROM customer JOIN (VALUES (0), (1)) d(delivery) ON delivery = 0 OR c_custkey % 50 = 0""",
    ),
    "profile": (
        ("profile_raw",),
        f"""SELECT user_id, regexp_replace({strip('face')}, '{SPACE}*/{SPACE}*', '/', 'g') AS face FROM profile_raw
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ingest_id) = 1""",
    ),
    "category_raw": (
        ("behaviour",),
        f"""SELECT category_id + delivery * {SECOND} AS ingest_id, category_id, CAST(n AS INTEGER) AS category_count,
        'cat' || category_id || CASE WHEN delivery = 1 THEN ' later' ELSE '' END AS category_label
        FROM (SELECT category_id, COUNT(*) AS n FROM behaviour GROUP BY category_id) c
        JOIN (VALUES (0), (1)) d(delivery) ON delivery = 0 OR category_id = 3 WHERE category_id <> 9""",
    ),
    "category": (
        ("category_raw",),
        """SELECT category_id, category_count, category_label FROM category_raw
        QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY ingest_id) = 1""",
    ),
    "features": (
        ("dwd",),
        """SELECT id, user_id, goods_id, COALESCE(sex, 0) AS sex, browse_goods_types, total_behavior_count,
        goods_hot_score, CAST(CASE WHEN event_hour = (SELECT event_hour FROM dwd GROUP BY event_hour
        ORDER BY COUNT(*) DESC, event_hour LIMIT 1) THEN 1 ELSE 0 END AS INTEGER) AS is_peak_hour,
        CAST(CASE WHEN isodow(event_date) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
        row_number() OVER (PARTITION BY user_id, goods_id ORDER BY id) AS user_goods_count,
        CAST(CASE WHEN category_id IN (0, 1, 2) THEN 1 ELSE 0 END AS INTEGER) AS is_hot_category,
        CAST(CASE WHEN behavior = 'buy' THEN 1 ELSE 0 END AS INTEGER) AS label
        FROM dwd JOIN (SELECT user_id, COUNT(*) AS total_behavior_count,
        COUNT(DISTINCT goods_id) AS browse_goods_types FROM dwd GROUP BY user_id) USING (user_id)
        JOIN (SELECT goods_id, COUNT(*) AS goods_hot_score FROM dwd GROUP BY goods_id) USING (goods_id)""",
    ),
    "daily": (
        ("dwd",),
        """SELECT *, AVG(conversion_rate) OVER (ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        AS trailing_mean FROM (SELECT event_date, COUNT(*) AS total_behavior,
        COUNT(*) FILTER (WHERE behavior = 'buy') AS buy_count,
        COUNT(*) FILTER (WHERE behavior = 'buy') / CAST(COUNT(*) AS DOUBLE) AS conversion_rate
        FROM dwd GROUP BY event_date)""",
    ),
    "reviews": (
        (),
        f"""SELECT doc_id + delivery * {SECOND} AS ingest_id, doc_id % 50 AS user_id, doc_id % 20 AS goods_id,
        doc_id % 10 AS category_id, CASE WHEN delivery = 0 THEN text WHEN doc_id % 25 = 0 THEN text || '!'
        WHEN doc_id % 100 = 1 THEN NULL WHEN doc_id % 100 = 2 THEN 'ok' ELSE '    ' END AS comment
        FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' ' || [{_PHRASES}][doc_id % {len(PHRASES)} + 1]
        ELSE text END AS text FROM documents) JOIN (VALUES (0), (1)) d(delivery)
        ON delivery = 0 OR doc_id % 25 = 0 OR doc_id % 100 IN (1, 2, 3)""",
    ),
    "long_reviews": (
        ("reviews",),
        rf"""SELECT *, regexp_replace(comment, '[^\p{{L}}\p{{N}}_]', '', 'g') AS norm
        FROM (SELECT * REPLACE ({strip('comment')} AS comment) FROM reviews WHERE comment IS NOT NULL)
        WHERE length(comment) >= {K.MIN_REVIEW_CHARS}""",
    ),
    "cleaned": (
        ("long_reviews",),
        """SELECT * FROM long_reviews
        QUALIFY row_number() OVER (PARTITION BY user_id, goods_id, norm ORDER BY ingest_id) = 1""",
    ),
    "words": (("cleaned",), f"SELECT ingest_id, {tokens('comment')} AS words FROM cleaned"),
    "word_rows": (("words",), "SELECT ingest_id, unnest(words) AS token FROM words"),
    "marks": (
        (),
        f"""SELECT doc_id AS ingest_id, CASE WHEN toxic = 1 OR quality = 0 THEN 0 ELSE 1 END AS is_positive,
        CASE WHEN doc_id % 40 = 0 THEN '模糊' WHEN toxic = 1 THEN '真负面' WHEN quality = 0 THEN '真中性'
        ELSE '真正面' END AS gold FROM labels""",
    ),
    "token_counts": (
        ("word_rows", "marks"),
        """SELECT token, COUNT(*) FILTER (WHERE is_positive = 1) AS positive,
        COUNT(*) FILTER (WHERE is_positive = 0) AS negative
        FROM word_rows JOIN marks USING (ingest_id) GROUP BY token""",
    ),
    "log_odds": (
        ("token_counts",),
        """SELECT token, positive, negative,
        ln((positive + 1) / CAST((SELECT SUM(positive) + COUNT(*) FROM token_counts) AS DOUBLE))
        - ln((negative + 1) / CAST((SELECT SUM(negative) + COUNT(*) FROM token_counts) AS DOUBLE)) AS log_odds
        FROM token_counts""",
    ),
    "scored": (
        ("cleaned", "word_rows", "log_odds", "marks"),
        f"""SELECT *, {band('score')} AS label FROM (SELECT c.*, round(1.0 / (1.0 + exp(-(COALESCE(evidence, 0.0)
        + (SELECT ln(CAST(COUNT(*) FILTER (WHERE is_positive = 1) AS DOUBLE)
        / COUNT(*) FILTER (WHERE is_positive = 0)) FROM marks JOIN cleaned USING (ingest_id))))), 6) AS score
        FROM cleaned c LEFT JOIN (SELECT ingest_id, SUM(log_odds) AS evidence
        FROM word_rows JOIN log_odds USING (token) GROUP BY ingest_id) USING (ingest_id))""",
    ),
    "fixed": (
        ("cleaned",),
        f"""SELECT *, {band('score')} AS label, {band('score_b')} AS label_b FROM (SELECT *,
        CAST(ingest_id * 7919 % 100 AS DOUBLE) / 100 AS score,
        CAST(ingest_id * 104729 % 100 AS DOUBLE) / 100 AS score_b FROM cleaned)""",
    ),
    "gold_sheet": (
        ("cleaned", "marks"),
        "SELECT user_id, goods_id, comment, gold FROM cleaned JOIN marks USING (ingest_id)",
    ),
    "gold": (
        ("gold_sheet", "fixed"),
        f"""SELECT g.*, f.ingest_id, f.category_id, f.score, f.label, f.score_b, f.label_b,
        replace(g.gold, '真', '') AS gold_std FROM gold_sheet g LEFT JOIN fixed f
        USING (user_id, goods_id, comment) WHERE g.gold <> '模糊'""",
    ),
    "steps": (
        ("gold",),
        f"""SELECT *, SUM(hits) OVER down AS hits_upto, SUM(n) OVER down AS n_upto FROM (
        SELECT 1 - score AS threshold, COUNT(*) FILTER (WHERE gold_std = '{K.NEGATIVE}') AS hits, COUNT(*) AS n
        FROM gold GROUP BY 1 - score) WINDOW down AS (ORDER BY threshold DESC)""",
    ),
    "paired": (
        ("gold",),
        f"""SELECT COUNT(*) FILTER (WHERE a AND b) AS both_right, COUNT(*) FILTER (WHERE a AND NOT b) AS only_a_right,
        COUNT(*) FILTER (WHERE NOT a AND b) AS only_b_right, COUNT(*) FILTER (WHERE NOT a AND NOT b) AS both_wrong
        FROM (SELECT (label = '{K.NEGATIVE}') = (gold_std = '{K.NEGATIVE}') AS a,
        (label_b = '{K.NEGATIVE}') = (gold_std = '{K.NEGATIVE}') AS b FROM gold)""",
    ),
    "paired_p": (
        ("paired",),
        f"""SELECT *, round(CASE
        WHEN only_a_right + only_b_right < {K.EXACT_TEST_BELOW} THEN least(1.0, 2 * list_sum(list_transform(
            range(0, least(only_a_right, only_b_right) + 1), lambda k: round(exp(lgamma(only_a_right + only_b_right + 1)
            - lgamma(k + 1) - lgamma(only_a_right + only_b_right - k + 1))))) / pow(2, only_a_right + only_b_right))
        WHEN z = 0 THEN 1.0
        ELSE 1 - exp(-z * z) * list_sum(list_transform(range(0, 400),
            lambda i: exp((2 * i + 1) * ln(z) - lgamma(i + 1.5)))) END, 6) AS p_value
        FROM (SELECT *, sqrt(pow(abs(only_a_right - only_b_right) - 1, 2)
        / greatest(only_a_right + only_b_right, 1) / 2) AS z FROM paired)""",
    ),
    "terms": (
        ("cleaned",),
        f"""SELECT ingest_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))
        AS term FROM (SELECT ingest_id, {tokens('lower(comment)')} AS w FROM cleaned)""",
    ),
    "term_counts": (("terms",), "SELECT ingest_id, term, COUNT(*) AS tf FROM terms GROUP BY ingest_id, term"),
    "term_df": (
        ("term_counts",),
        "SELECT term, COUNT(*) AS df FROM term_counts GROUP BY term HAVING COUNT(*) >= 2",
    ),
}


def sql(select: str, *views: str) -> str:
    """`select` with the named views, and the views those need, as common table expressions."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    heads = ",\n".join(f"{name} AS MATERIALIZED ({VIEWS[name][1]})" for name in ordered)
    return f"WITH {heads}\n{select}"


def weighted_recall(pred: str) -> str:
    """Precision, recall and band-weighted figures of one prediction column, one row."""
    neg = K.NEGATIVE
    return f"""SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(rw, 6) AS recall_w,
    round(CASE WHEN p + rw > 0 THEN 2 * p * rw / (p + rw) ELSE 0.0 END, 6) AS f1_w FROM (SELECT
    (SELECT COUNT(*) FILTER (WHERE {pred} = '{neg}' AND gold_std = '{neg}')
        / CAST(COUNT(*) FILTER (WHERE {pred} = '{neg}') AS DOUBLE) FROM gold) AS p,
    (SELECT COUNT(*) FILTER (WHERE {pred} = '{neg}' AND gold_std = '{neg}')
        / CAST(COUNT(*) FILTER (WHERE gold_std = '{neg}') AS DOUBLE) FROM gold) AS r,
    (SELECT SUM(CASE WHEN band = '{neg}' THEN share * n END) / SUM(share * n) FROM
        (SELECT {pred} AS band, COUNT(*) AS n FROM fixed GROUP BY {pred}) JOIN
        (SELECT {pred} AS band, AVG(CASE WHEN gold_std = '{neg}' THEN 1.0 ELSE 0.0 END) AS share
         FROM gold GROUP BY {pred}) USING (band)) AS rw)"""
