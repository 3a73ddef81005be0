"""The query catalogue: every operator as a query over the given tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from shoplayers import constants as K
from shoplayers.functions.columns import clean_label
from shoplayers.functions.ordered import exact_quantiles
from shoplayers.operators import cleaning, evaluation, learning, quality, sampling, text
from shoplayers.plans import comparison, exploration, oracle, reports, reviews, roundtrips, warehouse
from shoplayers.plans.oracle import REFERENCE_DATE, mean, money_mean, order_case, pct, quoted, sql, weighted_recall
from shoplayers.session import durable, stored
from shoplayers.sources import views

FIXTURE_HOT_CATEGORIES = (0, 1, 2)
NUMERIC = ("user_id", "goods_id", "category_id", "price", "amount", "sex")
TEMPLATE_THRESHOLD = 2


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CATALOG: dict[str, Query] = {}


def _query(name: str, statement: str | None = None):
    def register(run):
        CATALOG[name] = Query(run, statement)
        return run

    return register


# --- shared inputs -----------------------------------------------------------------------------


def _dwd(spark, folder):
    return warehouse.build_dwd(views.behaviour(spark, folder))


def _user_day(spark, folder):
    return warehouse.build_user_day(_dwd(spark, folder))


def _rfm_raw(spark, folder):
    return warehouse.build_rfm_raw(_user_day(spark, folder), REFERENCE_DATE)


def _segments(spark, folder):
    return warehouse.rfm_segments(_user_day(spark, folder), REFERENCE_DATE)


def _profile(spark, folder):
    raw = views.profile_raw(spark, folder)
    cleaned = raw.withColumn("face", clean_label(F.col("face")))
    return cleaning.keep_first(cleaned, ["user_id"]).select("user_id", "face")


def _category(spark, folder):
    return cleaning.keep_first(views.category_raw(spark, folder), ["category_id"]).drop("ingest_id")


def _cleaned(spark, folder):
    return text.clean_reviews(views.reviews(spark, folder))


def _scored(spark, folder):
    return text.fit_and_score(_cleaned(spark, folder), views.labels(spark, folder))


def _scored_table(spark, folder):
    """Scored reviews with the buckets of their terms, stored once for jobs that read them several times."""
    return stored(learning.with_buckets(_scored(spark, folder)))


def _stored_reviews(spark, folder):
    """Cleaned reviews, stored once for jobs that read them several times."""
    return stored(_cleaned(spark, folder).drop("norm"))


def _fixed(spark, folder):
    return views.fixed_predictions(_cleaned(spark, folder).drop("norm"))


def _gold_sheet(spark, folder):
    return views.gold_sheet(_cleaned(spark, folder), views.labels(spark, folder))


def _judged(spark, folder, check: bool = False):
    """Gold rows with both fixed predictions, and all reviews with them."""
    kept = _stored_reviews(spark, folder)
    fixed = views.fixed_predictions(kept)
    return evaluation.join_gold(views.gold_sheet(kept, views.labels(spark, folder)), fixed, check), fixed


def _gold(spark, folder):
    return _judged(spark, folder)[0]


def _features(spark, folder):
    return exploration.model_features(_dwd(spark, folder), FIXTURE_HOT_CATEGORIES)


# --- raw layer ---------------------------------------------------------------------------------


@_query(
    "ods_timestamp_health",
    sql(
        """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE timestamp IS NULL OR timestamp = '') AS null_or_empty,
        COUNT(*) FILTER (WHERE regexp_full_match(timestamp, '[0-9]+')) AS pure_numeric,
        COUNT(*) FILTER (WHERE NOT COALESCE(regexp_full_match(timestamp, '[0-9]+'), false)) AS non_numeric
        FROM behaviour""",
        "behaviour",
    ),
)
def ods_timestamp_health(spark, folder):
    return quality.timestamp_health(views.behaviour(spark, folder))


@_query(
    "ods_bad_timestamps_top",
    sql(
        """SELECT timestamp, COUNT(*) AS cnt FROM behaviour
        WHERE NOT COALESCE(regexp_full_match(timestamp, '[0-9]+'), false)
        GROUP BY timestamp ORDER BY cnt DESC, timestamp NULLS FIRST LIMIT 20""",
        "behaviour",
    ),
)
def ods_bad_timestamps_top(spark, folder):
    return quality.bad_timestamps(views.behaviour(spark, folder))


@_query(
    "ods_price_amount_audit",
    sql(
        """SELECT behavior, COUNT(*) FILTER (WHERE price > 0) AS has_price,
        COUNT(*) FILTER (WHERE amount > 0) AS has_amount FROM behaviour_gaps GROUP BY behavior""",
        "behaviour_gaps",
    ),
)
def ods_price_amount_audit(spark, folder):
    return quality.price_amount_audit(views.behaviour_with_gaps(spark, folder))


@_query(
    "behavior_distribution",
    sql(
        f"""SELECT behavior, cnt, {pct('cnt', '(SELECT COUNT(*) FROM behaviour)')} AS pct
        FROM (SELECT behavior, COUNT(*) AS cnt FROM behaviour GROUP BY behavior)""",
        "behaviour",
    ),
)
def behavior_distribution(spark, folder):
    return reports.frequency(views.behaviour(spark, folder), "behavior")


# --- detail layer ------------------------------------------------------------------------------


@_query("dwd_clean", sql("SELECT * FROM dwd", "dwd"))
def dwd_clean(spark, folder):
    return _dwd(spark, folder)


@_query(
    "dwd_quarantine",
    sql(
        f"""SELECT reason, COUNT(*) AS cnt FROM (SELECT CASE WHEN regexp_full_match(timestamp, '[0-9]+')
        AND TRY_CAST(timestamp AS BIGINT) <= {K.MAX_EPOCH_SECOND} THEN 'behavior' ELSE 'timestamp' END AS reason
        FROM behaviour WHERE ingest_id NOT IN (SELECT id FROM dwd)) GROUP BY reason""",
        "behaviour", "dwd",
    ),
)
def dwd_quarantine(spark, folder):
    rejected = warehouse.quarantine(views.behaviour(spark, folder))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("cnt"))


@_query(
    "dwd_tolerant_parse",
    sql(
        """SELECT ingest_id, user_id, goods_id, behavior, seconds,
        TIMESTAMP '1970-01-01 00:00:00' + to_microseconds(CAST(round(seconds * 1000000) AS BIGINT)) AS behavior_time,
        CAST(hour(TIMESTAMP '1970-01-01 00:00:00' + to_microseconds(CAST(round(seconds * 1000000) AS BIGINT)))
        AS INTEGER) AS hour
        FROM (SELECT *, TRY_CAST(timestamp AS DOUBLE) AS seconds FROM behaviour)
        WHERE isfinite(seconds) AND seconds BETWEEN -62135596800 AND 32536771199""",
        "behaviour",
    ),
)
def dwd_tolerant_parse(spark, folder):
    parsed = warehouse.parse_tolerantly(views.behaviour(spark, folder))
    return parsed.select("ingest_id", "user_id", "goods_id", "behavior", "seconds", "behavior_time", "hour")


@_query(
    "dwd_last_rows",
    sql(
        """SELECT id, user_id, behavior, event_time, event_date, event_hour, address
        FROM dwd ORDER BY id DESC LIMIT 10""",
        "dwd",
    ),
)
def dwd_last_rows(spark, folder):
    return reports.last_rows(_dwd(spark, folder))


@_query(
    "dwd_date_coverage",
    sql(
        """SELECT MIN(event_date) AS start_date, MAX(event_date) AS end_date,
        COUNT(DISTINCT event_date) AS days FROM dwd""",
        "dwd",
    ),
)
def dwd_date_coverage(spark, folder):
    return reports.date_coverage(_dwd(spark, folder))


@_query(
    "dwd_behavior_distribution",
    sql(
        f"""SELECT behavior, cnt, {pct('cnt', '(SELECT COUNT(*) FROM dwd)')} AS pct
        FROM (SELECT behavior, COUNT(*) AS cnt FROM dwd GROUP BY behavior)""",
        "dwd",
    ),
)
def dwd_behavior_distribution(spark, folder):
    return reports.frequency(_dwd(spark, folder), "behavior")


@_query(
    "layer_row_reconciliation",
    sql(
        """SELECT 'ods' AS layer, COUNT(*) AS rows_cnt FROM behaviour UNION ALL SELECT 'dwd', COUNT(*) FROM dwd
        UNION ALL SELECT 'lost', (SELECT COUNT(*) FROM behaviour) - (SELECT COUNT(*) FROM dwd)""",
        "behaviour", "dwd",
    ),
)
def layer_row_reconciliation(spark, folder):
    return quality.reconcile_rows(views.behaviour(spark, folder), warehouse.is_clean())


# --- daily layer -------------------------------------------------------------------------------


@_query("user_day", sql("SELECT * FROM user_day", "user_day"))
def user_day(spark, folder):
    return _user_day(spark, folder)


@_query("user_day_one_user", sql("SELECT * FROM user_day WHERE user_id = 8", "user_day"))
def user_day_one_user(spark, folder):
    return warehouse.one_user(_user_day(spark, folder), 8)


@_query(
    "layer_sizes",
    sql(
        """SELECT 'dwd' AS layer, COUNT(*) AS rows_cnt FROM dwd UNION ALL SELECT 'dws', COUNT(*) FROM user_day
        UNION ALL SELECT 'users', COUNT(DISTINCT user_id) FROM user_day""",
        "dwd", "user_day",
    ),
)
def layer_sizes(spark, folder):
    return quality.layer_sizes(_dwd(spark, folder))


@_query(
    "layer_totals",
    sql(
        """SELECT CAST(SUM(pv_cnt) AS BIGINT) AS total_pv, CAST(SUM(cart_cnt) AS BIGINT) AS total_cart,
        CAST(SUM(fav_cnt) AS BIGINT) AS total_fav, CAST(SUM(buy_cnt) AS BIGINT) AS total_buy,
        CAST(SUM(buy_amount) AS DECIMAL(20,2)) AS total_gmv FROM user_day""",
        "user_day",
    ),
)
def layer_totals(spark, folder):
    return reports.layer_totals(_user_day(spark, folder))


_SUMS = " UNION ALL ".join(
    f"""SELECT '{b}' AS metric, CAST((SELECT COUNT(*) FROM dwd WHERE behavior = '{b}') AS DECIMAL(20,2)) AS dwd_total,
    CAST((SELECT SUM({b}_cnt) FROM user_day) AS DECIMAL(20,2)) AS dws_total"""
    for b in K.BEHAVIOURS
)


@_query(
    "layer_totals_reconciliation",
    sql(
        f"""SELECT *, CAST(dwd_total - dws_total AS DECIMAL(21,2)) AS diff FROM ({_SUMS} UNION ALL
        SELECT 'gmv', CAST((SELECT SUM(price * amount) FROM dwd WHERE behavior = 'buy') AS DECIMAL(20,2)),
        CAST((SELECT SUM(buy_amount) FROM user_day) AS DECIMAL(20,2)))""",
        "dwd", "user_day",
    ),
)
def layer_totals_reconciliation(spark, folder):
    dwd = _dwd(spark, folder)
    return reports.totals_reconciliation(dwd, warehouse.build_user_day(dwd))


@_query(
    "daily_active_users",
    sql(
        f"""SELECT event_date, dau, buyers, {pct('buyers', 'dau')} AS buy_rate_pct FROM (SELECT event_date,
        COUNT(*) AS dau, CAST(SUM(is_buyer) AS BIGINT) AS buyers FROM user_day GROUP BY event_date)""",
        "user_day",
    ),
)
def daily_active_users(spark, folder):
    return reports.daily_active_users(_user_day(spark, folder))


@_query(
    "buyer_population",
    sql(
        """SELECT COUNT(DISTINCT user_id) AS total_users, CAST(SUM(is_buyer) AS BIGINT) AS buyer_user_days,
        COUNT(DISTINCT CASE WHEN is_buyer = 1 THEN user_id END) AS distinct_buyers FROM user_day""",
        "user_day",
    ),
)
def buyer_population(spark, folder):
    return reports.buyer_population(_user_day(spark, folder))


# --- segments ----------------------------------------------------------------------------------


@_query("rfm_raw", sql("SELECT * FROM rfm_raw", "rfm_raw"))
def rfm_raw(spark, folder):
    return _rfm_raw(spark, folder)


@_query("rfm_scores", sql("SELECT * FROM rfm_scores", "rfm_scores"))
def rfm_scores(spark, folder):
    return warehouse.build_rfm_scores(_rfm_raw(spark, folder))


@_query(
    "order_price_tiles",
    """SELECT o_orderkey, price, CAST(NTILE(4) OVER (ORDER BY price, o_orderkey) AS INTEGER) AS tile
    FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS price FROM orders)""",
)
def order_price_tiles(spark, folder):
    return warehouse.tile_scores(views.orders(spark, folder), "price", "o_orderkey")


@_query("rfm_segments", sql("SELECT * FROM segments", "segments"))
def rfm_segments(spark, folder):
    return _segments(spark, folder)


@_query("rfm_segment_one_user", sql("SELECT * FROM segments WHERE user_id = 8", "segments"))
def rfm_segment_one_user(spark, folder):
    return warehouse.one_user(_segments(spark, folder), 8)


@_query(
    "rfm_segment_share",
    sql(
        f"""SELECT user_segment, users, {pct('users', '(SELECT COUNT(*) FROM segments)')} AS pct,
        {order_case('user_segment', K.SEGMENT_ORDER)} AS display_order
        FROM (SELECT user_segment, COUNT(*) AS users FROM segments GROUP BY user_segment)""",
        "segments",
    ),
)
def rfm_segment_share(spark, folder):
    return reports.segment_share(_segments(spark, folder))


def _means(digits: int) -> str:
    return f"""SELECT user_segment, COUNT(*) AS users, {mean('SUM(r_days)', 'COUNT(*)', digits)} AS avg_r_days,
    {mean('SUM(f_freq)', 'COUNT(*)', digits)} AS avg_f_freq, {money_mean('m_amount')} AS avg_m_amount
    FROM segments GROUP BY user_segment"""


@_query("rfm_segment_means", sql(_means(1), "segments"))
def rfm_segment_means(spark, folder):
    return reports.segment_means(_segments(spark, folder))


@_query(
    "rfm_segment_report",
    sql(f"SELECT *, {pct('users', '(SELECT COUNT(*) FROM segments)')} AS pct FROM ({_means(1)})", "segments"),
)
def rfm_segment_report(spark, folder):
    return reports.segment_report(_segments(spark, folder))


def _scaled(column: str, reverse: bool = False) -> str:
    low, high = f"MIN({column}) OVER ()", f"MAX({column}) OVER ()"
    distance = f"{high} - {column}" if reverse else f"{column} - {low}"
    return f"round(CASE WHEN {high} > {low} THEN ({distance}) / ({high} - {low}) ELSE 0.0 END, 6)"


@_query(
    "rfm_means_scaled",
    sql(
        f"""SELECT user_segment, {order_case('user_segment', K.SEGMENT_ORDER)} AS display_order,
        {_scaled('avg_r_days', True)} AS r_scaled, {_scaled('avg_f_freq')} AS f_scaled,
        {_scaled('m')} AS m_scaled FROM (SELECT *, CAST(avg_m_amount AS DOUBLE) AS m FROM ({_means(2)}))""",
        "segments",
    ),
)
def rfm_means_scaled(spark, folder):
    return reports.segment_means_scaled(_segments(spark, folder))


_HIGH = f"user_segment IN ({quoted(K.HIGH_VALUE_SEGMENTS)})"


@_query(
    "high_value_by_occupation",
    sql(
        f"""SELECT COALESCE(face, '{K.UNKNOWN}') AS occupation, high_value_users FROM (
        SELECT face, COUNT(*) AS high_value_users FROM segments LEFT JOIN profile USING (user_id)
        WHERE {_HIGH} GROUP BY face ORDER BY high_value_users DESC, face NULLS FIRST LIMIT 10)""",
        "segments", "profile",
    ),
)
def high_value_by_occupation(spark, folder):
    return reports.high_value_by_occupation(_segments(spark, folder), _profile(spark, folder))


@_query(
    "high_value_share_by_occupation",
    sql(
        f"""SELECT *, {pct('high_value', 'total_users')} AS high_value_pct FROM (SELECT face AS occupation,
        COUNT(*) AS total_users, COUNT(*) FILTER (WHERE {_HIGH}) AS high_value
        FROM profile LEFT JOIN segments USING (user_id) GROUP BY face HAVING COUNT(*) >= 100)""",
        "segments", "profile",
    ),
)
def high_value_share_by_occupation(spark, folder):
    return reports.high_value_share_by_occupation(_segments(spark, folder), _profile(spark, folder))


_WIDE = """SELECT trim(replace(face, ' ', '')) AS face, user_id, r_days, f_freq, m_amount, r_score, f_score,
    m_score, user_segment FROM profile LEFT JOIN segments USING (user_id)"""


@_query("validation_wide", sql(_WIDE, "segments", "profile"))
def validation_wide(spark, folder):
    return reports.validation_wide(_segments(spark, folder), _profile(spark, folder))


@_query(
    "validation_control_totals",
    sql(
        f"""SELECT COUNT(*) AS rows_cnt, COUNT(DISTINCT face) AS occupations, COUNT(DISTINCT user_id) AS users,
        COUNT(r_days) AS buyers, CAST(SUM(m_amount) AS DECIMAL(14,2)) AS amount FROM ({_WIDE})""",
        "segments", "profile",
    ),
)
def validation_control_totals(spark, folder):
    return reports.validation_totals(reports.validation_wide(_segments(spark, folder), _profile(spark, folder)))


@_query(
    "user_funnel",
    sql(
        """SELECT *, CASE WHEN stage_no = 1 THEN 100.0::DOUBLE ELSE
        round(COALESCE(users * 100.0 / NULLIF(CAST(first(users) OVER (ORDER BY stage_no) AS DOUBLE), 0), 0), 6) END
        AS overall_pct, CASE WHEN stage_no = 1 THEN 100.0::DOUBLE ELSE
        round(COALESCE(users * 100.0 / NULLIF(CAST(lag(users) OVER (ORDER BY stage_no) AS DOUBLE), 0), 0), 6) END
        AS step_pct FROM (SELECT CAST(s.n AS INTEGER) AS stage_no, s.stage, COUNT(DISTINCT user_id) AS users
        FROM (VALUES (1, 'pv'), (2, 'cart'), (3, 'buy'), (4, 'fav')) s(n, stage)
        LEFT JOIN dwd ON dwd.behavior = s.stage GROUP BY ALL)""",
        "dwd",
    ),
)
def user_funnel(spark, folder):
    return reports.user_funnel(_dwd(spark, folder))


# --- dimensions and quality --------------------------------------------------------------------


@_query("profile_label_clean", sql("SELECT * FROM profile", "profile"))
def profile_label_clean(spark, folder):
    return _profile(spark, folder)


@_query(
    "profile_cleaning_effect",
    sql(
        f"""SELECT COUNT(*) AS rows_before, COUNT(DISTINCT user_id) AS rows_after, COUNT(DISTINCT face) AS face_before,
        COUNT(DISTINCT regexp_replace({oracle.strip('face')}, '{oracle.SPACE}*/{oracle.SPACE}*', '/', 'g'))
        AS face_after FROM profile_raw""",
        "profile_raw",
    ),
)
def profile_cleaning_effect(spark, folder):
    raw = views.profile_raw(spark, folder)
    return cleaning.cleaning_effect(raw, {"face": clean_label(F.col("face"))}, ["user_id"])


@_query("dim_category_dedup", sql("SELECT * FROM category", "category"))
def dim_category_dedup(spark, folder):
    return _category(spark, folder)


_CHECKED = ("user_id", "goods_id", "behavior", "timestamp", "sex", "price", "amount")


@_query(
    "null_and_key_violations",
    sql(
        " UNION ALL ".join(
            f"SELECT 'not_null:{c}' AS check_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM behaviour_gaps"
            for c in _CHECKED
        )
        + """ UNION ALL SELECT 'unique:row', COUNT(*) FROM (SELECT ingest_id FROM behaviour_gaps
        GROUP BY ingest_id HAVING COUNT(*) > 1)
        UNION ALL SELECT 'unique:user_goods', COUNT(*) FROM (SELECT user_id, goods_id FROM behaviour_gaps
        GROUP BY user_id, goods_id HAVING COUNT(*) > 1)""",
        "behaviour_gaps",
    ),
)
def null_and_key_violations(spark, folder):
    keys = {"row": ["ingest_id"], "user_goods": ["user_id", "goods_id"]}
    return quality.violations(views.behaviour_with_gaps(spark, folder), _CHECKED, keys)


# --- row preprocessing -------------------------------------------------------------------------

_FILLED = f"""SELECT * REPLACE (COALESCE(sex, (SELECT sex FROM {{rows}} WHERE sex IS NOT NULL AND timestamp IS NOT NULL
    GROUP BY sex ORDER BY COUNT(*) DESC, sex LIMIT 1), 0) AS sex, COALESCE(price, 0) AS price,
    COALESCE(amount, 0) AS amount, COALESCE(address, '{K.UNKNOWN}') AS address,
    COALESCE(device, '{K.UNKNOWN}') AS device, COALESCE(comment, '{K.NO_COMMENT}') AS comment)
    FROM {{rows}} WHERE timestamp IS NOT NULL"""


def _clamped(rows: str) -> str:
    return f"""SELECT * REPLACE (least(CAST(price AS DOUBLE), (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99)
    FROM ({rows}))) AS price, CAST(greatest(0, least(amount, 100)) AS INTEGER) AS amount) FROM ({rows})"""


def _rounded_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price", F.round("price", 6))


@_query(
    "preprocess_fill_clamp",
    sql(
        f"SELECT * REPLACE (round(price, 6) AS price) FROM ({_clamped(_FILLED.format(rows='behaviour_gaps'))})",
        "behaviour_gaps",
    ),
)
def preprocess_fill_clamp(spark, folder):
    filled = cleaning.fill_gaps(views.behaviour_with_gaps(spark, folder))
    return _rounded_price(cleaning.clamp_outliers(filled))


@_query(
    "preprocess_dedup",
    sql(
        """SELECT * FROM behaviour_twice QUALIFY row_number() OVER
        (PARTITION BY user_id, goods_id, behavior, timestamp ORDER BY ingest_id) = 1""",
        "behaviour_twice",
    ),
)
def preprocess_dedup(spark, folder):
    return cleaning.drop_duplicate_events(views.behaviour_delivered_twice(spark, folder))


_TOLERANT = """SELECT * FROM (SELECT *, TRY_CAST(timestamp AS DOUBLE) AS seconds FROM behaviour_gaps)
    WHERE isfinite(seconds) AND seconds BETWEEN -62135596800 AND 32536771199"""
_DISTINCT = f"""SELECT * FROM ({_FILLED.format(rows=f'({_TOLERANT})')}) QUALIFY row_number() OVER
    (PARTITION BY user_id, goods_id, behavior, seconds ORDER BY ingest_id) = 1"""


@_query(
    "exploration_detail",
    sql(
        f"""SELECT ingest_id AS id, user_id, goods_id, category_id, behavior, event_time,
        CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS event_hour, sex, address, device,
        round(price, 6) AS price, amount, comment FROM (SELECT *, TIMESTAMP '1970-01-01 00:00:00'
        + to_microseconds(CAST(round(seconds * 1000000) AS BIGINT)) AS event_time FROM ({_clamped(_DISTINCT)}))""",
        "behaviour_gaps",
    ),
)
def exploration_detail(spark, folder):
    return _rounded_price(exploration.prepared_detail(views.behaviour_with_gaps(spark, folder)))


@_query(
    "price_quantiles",
    sql(
        """SELECT 'price' AS column_name, round(quantile_cont(CAST(price AS DOUBLE), 0.5), 6) AS q0,
        round(quantile_cont(CAST(price AS DOUBLE), 0.8), 6) AS q1,
        round(quantile_cont(CAST(price AS DOUBLE), 0.99), 6) AS q2 FROM behaviour_gaps""",
        "behaviour_gaps",
    ),
)
def price_quantiles(spark, folder):
    found = exact_quantiles(views.behaviour_with_gaps(spark, folder), ["price"], [0.5, 0.8, 0.99])
    return found.select("column_name", *[F.round(q, 6).alias(q) for q in ("q0", "q1", "q2")])


@_query("preprocess_features", sql("SELECT * FROM features", "features"))
def preprocess_features(spark, folder):
    return _features(spark, folder)


@_query(
    "user_behavior_totals",
    sql(
        """SELECT user_id, COUNT(*) AS total_behavior_count, COUNT(DISTINCT goods_id) AS browse_goods_types
        FROM dwd GROUP BY user_id""",
        "dwd",
    ),
)
def user_behavior_totals(spark, folder):
    return exploration.user_totals(_dwd(spark, folder))


@_query(
    "goods_popularity", sql("SELECT goods_id, COUNT(*) AS goods_hot_score FROM dwd GROUP BY goods_id", "dwd")
)
def goods_popularity(spark, folder):
    return exploration.goods_totals(_dwd(spark, folder))


# --- exploration -------------------------------------------------------------------------------


def _described(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    cells = ", ".join(
        f"round({expression}, 2) AS {name}"
        for name, expression in {
            "mean": f"AVG({value})",
            "std": f"stddev_samp({value})",
            "min": f"MIN({value})",
            "q25": f"quantile_cont({value}, 0.25)",
            "q50": f"quantile_cont({value}, 0.5)",
            "q75": f"quantile_cont({value}, 0.75)",
            "max": f"MAX({value})",
        }.items()
    )
    return f"SELECT '{column}' AS column_name, COUNT({column}) AS n, {cells} FROM behaviour_gaps"


@_query("describe_numeric", sql(" UNION ALL ".join(_described(c) for c in NUMERIC), "behaviour_gaps"))
def describe_numeric(spark, folder):
    return exploration.describe_numeric(views.behaviour_with_gaps(spark, folder), NUMERIC)


@_query("hour_histogram", sql("SELECT event_hour, COUNT(*) AS cnt FROM dwd GROUP BY event_hour", "dwd"))
def hour_histogram(spark, folder):
    return exploration.hour_histogram(_dwd(spark, folder))


@_query(
    "top_categories",
    sql(
        """SELECT category_id, COUNT(*) AS cnt FROM behaviour GROUP BY category_id
        ORDER BY cnt DESC, category_id LIMIT 3""",
        "behaviour",
    ),
)
def top_categories(spark, folder):
    return reports.top_values(views.behaviour(spark, folder), "category_id", 3)


_CROSS = ", ".join(f"COUNT(*) FILTER (WHERE behavior = '{b}') AS {b}" for b in K.BEHAVIOURS)


@_query(
    "sex_behavior_crosstab",
    sql(
        f"""SELECT *, {', '.join(f'round({b} / CAST(pv + cart + fav + buy AS DOUBLE), 6) AS {b}_share'
        for b in K.BEHAVIOURS)} FROM (SELECT sex, {_CROSS} FROM dwd WHERE sex IS NOT NULL GROUP BY sex)""",
        "dwd",
    ),
)
def sex_behavior_crosstab(spark, folder):
    return exploration.sex_behavior_crosstab(_dwd(spark, folder))


@_query(
    "sex_behavior_correlation",
    sql(
        "SELECT "
        + ", ".join(
            f"round(corr(sex, CASE WHEN behavior = '{b}' THEN 1 ELSE 0 END), 6) AS {b}" for b in K.BEHAVIOURS
        )
        + " FROM dwd",
        "dwd",
    ),
)
def sex_behavior_correlation(spark, folder):
    return exploration.sex_behavior_correlation(_dwd(spark, folder))


@_query(
    "daily_conversion_trend",
    sql(
        """SELECT * REPLACE (round(conversion_rate, 6) AS conversion_rate, round(trailing_mean, 6) AS trailing_mean)
        FROM daily""",
        "daily",
    ),
)
def daily_conversion_trend(spark, folder):
    return exploration.daily_conversion_trend(_dwd(spark, folder))


@_query(
    "conversion_forecast",
    sql(
        """SELECT round(m, 6) AS latest_mean, round(CASE WHEN m > 0 THEN m * 1.05 ELSE m END, 6) AS predicted_rate
        FROM (SELECT CAST(arg_max(trailing_mean, event_date) AS DOUBLE) AS m FROM daily)""",
        "daily",
    ),
)
def conversion_forecast(spark, folder):
    return exploration.conversion_forecast(_dwd(spark, folder))


@_query(
    "peak_lift",
    sql(
        """SELECT peak_hour, round(peak, 6) AS peak_rate, round(other, 6) AS other_rate,
        round(CASE WHEN other > 0 THEN peak / other ELSE 0 END, 6) AS lift FROM (SELECT any_value(h) AS peak_hour,
        AVG(CASE WHEN event_hour = h THEN b END) AS peak, AVG(CASE WHEN event_hour <> h THEN b END) AS other
        FROM (SELECT event_hour, CASE WHEN behavior = 'buy' THEN 1.0::DOUBLE ELSE 0.0 END AS b, (SELECT event_hour FROM dwd
        GROUP BY event_hour ORDER BY COUNT(*) DESC, event_hour LIMIT 1) AS h FROM dwd))""",
        "dwd",
    ),
)
def peak_lift(spark, folder):
    return exploration.peak_lift(_dwd(spark, folder))


@_query(
    "hot_goods_conversion",
    sql(
        """SELECT round(t, 6) AS threshold, COUNT(DISTINCT goods_id) FILTER (WHERE hot > t) AS hot_goods,
        COUNT(*) FILTER (WHERE hot > t) AS hot_rows,
        round(COALESCE(AVG(b) FILTER (WHERE hot > t), 0), 6) AS hot_rate FROM (
        SELECT goods_id, goods_hot_score AS hot, CAST(label AS DOUBLE) AS b,
        (SELECT quantile_cont(CAST(goods_hot_score AS DOUBLE), 0.8) FROM features) AS t FROM features) GROUP BY t""",
        "features",
    ),
)
def hot_goods_conversion(spark, folder):
    return exploration.hot_goods_conversion(_dwd(spark, folder))


@_query(
    "overall_conversion",
    sql(
        """SELECT COUNT(*) AS rows_cnt, COUNT(*) FILTER (WHERE behavior = 'buy') AS buys,
        round(COUNT(*) FILTER (WHERE behavior = 'buy') / CAST(COUNT(*) AS DOUBLE), 6) AS conversion_rate FROM dwd""",
        "dwd",
    ),
)
def overall_conversion(spark, folder):
    return exploration.overall_conversion(_dwd(spark, folder))


# --- reviews -----------------------------------------------------------------------------------


@_query(
    "review_cleaning_funnel",
    sql(
        """SELECT CAST(1 AS INTEGER) AS step_no, 'raw' AS step, COUNT(*) AS rows_cnt FROM reviews UNION ALL
        SELECT 2, 'with_text', COUNT(comment) FROM reviews UNION ALL
        SELECT 3, 'long_enough', COUNT(*) FROM long_reviews UNION ALL
        SELECT 4, 'deduplicated', COUNT(*) FROM cleaned""",
        "reviews", "long_reviews", "cleaned",
    ),
)
def review_cleaning_funnel(spark, folder):
    return text.review_funnel(views.reviews(spark, folder))


@_query("review_clean", sql("SELECT * FROM cleaned", "cleaned"))
def review_clean(spark, folder):
    return _cleaned(spark, folder)


@_query(
    "review_templates",
    sql(
        f"""SELECT norm, COUNT(*) AS occurrences, arg_min(comment, ingest_id) AS example FROM long_reviews
        GROUP BY norm HAVING COUNT(*) > {TEMPLATE_THRESHOLD}""",
        "long_reviews",
    ),
)
def review_templates(spark, folder):
    return text.review_templates(views.reviews(spark, folder), TEMPLATE_THRESHOLD)


@_query(
    "review_tokens",
    sql(
        "SELECT ingest_id, len(words) AS n_words, array_to_string(words, ' ') AS words FROM words", "words"
    ),
)
def review_tokens(spark, folder):
    worded = text.with_words(_cleaned(spark, folder))
    return worded.select(
        "ingest_id", F.size("words").cast("bigint").alias("n_words"), F.array_join("words", " ").alias("words")
    )


@_query(
    "token_log_odds",
    sql("SELECT token, positive, negative, round(log_odds, 6) AS log_odds FROM log_odds", "log_odds"),
)
def token_log_odds(spark, folder):
    fitted = text.token_log_odds(_cleaned(spark, folder), views.labels(spark, folder))
    return fitted.withColumn("log_odds", F.round("log_odds", 6))


_SCORED = "SELECT ingest_id, user_id, goods_id, category_id, comment, score, label FROM scored"


@_query("review_scores", sql(_SCORED, "scored"))
def review_scores(spark, folder):
    return _scored(spark, folder)


@_query(
    "sentiment_distribution",
    sql(
        f"""SELECT label, place, cnt, {pct('cnt', 'CAST(SUM(cnt) OVER () AS BIGINT)')} AS pct FROM (
        SELECT label, CAST(place AS INTEGER) AS place, COUNT(s.score) AS cnt
        FROM (VALUES ('{K.POSITIVE}', 0), ('{K.NEUTRAL}', 1), ('{K.NEGATIVE}', 2)) o(label, place)
        LEFT JOIN scored s USING (label) GROUP BY ALL)""",
        "scored",
    ),
)
def sentiment_distribution(spark, folder):
    return reviews.sentiment_distribution(_scored(spark, folder))


@_query(
    "top_words",
    sql("SELECT token, COUNT(*) AS cnt FROM word_rows GROUP BY token ORDER BY cnt DESC, token LIMIT 20", "word_rows"),
)
def top_words(spark, folder):
    return text.top_words(_cleaned(spark, folder))


@_query(
    "score_histogram",
    sql(
        """SELECT CAST(b.bin AS INTEGER) AS bin, COUNT(p.bin) AS cnt FROM range(1, 21) b(bin) LEFT JOIN (
        SELECT least(20, 1 + CAST(floor((score - low) * 20 / (high - low)) AS INTEGER)) AS bin
        FROM scored, (SELECT MIN(score) AS low, MAX(score) AS high FROM scored)) p ON p.bin = b.bin GROUP BY b.bin""",
        "scored",
    ),
)
def score_histogram(spark, folder):
    return reviews.score_histogram(_scored(spark, folder))


@_query(
    "category_negative_rate",
    sql(
        f"""SELECT category_id, total, neg, neg_pct, COALESCE(category_label, '{K.UNKNOWN_CATEGORY}') AS category_label
        FROM (SELECT *, {pct('neg', 'total', 6)} AS neg_pct FROM (SELECT category_id, COUNT(*) AS total,
        COUNT(*) FILTER (WHERE label = '{K.NEGATIVE}') AS neg FROM scored GROUP BY category_id HAVING COUNT(*) >= 20)
        ORDER BY neg / CAST(total AS DOUBLE) DESC, category_id LIMIT 10) LEFT JOIN category USING (category_id)""",
        "scored", "category",
    ),
)
def category_negative_rate(spark, folder):
    return reviews.category_negative_rate(_scored(spark, folder), _category(spark, folder))


@_query(
    "negative_reviews",
    sql(
        f"""SELECT user_id, goods_id, category_id, comment, round(score, 4) AS score FROM scored
        WHERE label = '{K.NEGATIVE}'""",
        "scored",
    ),
)
def negative_reviews(spark, folder):
    return reviews.negative_reviews(_scored(spark, folder))


@_query(
    "review_sheet_equidistant",
    sql(
        f"""SELECT ingest_id, score, substr(comment, 1, {K.SHEET_CHARS}) AS comment, '' AS review FROM (SELECT *,
        row_number() OVER (PARTITION BY score < 0.1 ORDER BY score, ingest_id) - 1 AS k,
        COUNT(*) OVER (PARTITION BY score < 0.1) AS size FROM fixed WHERE label = '{K.NEGATIVE}' AND score < 0.2)
        WHERE k % greatest(1, size // least(size, 10)) = 0
        AND k / greatest(1, size // least(size, 10)) < least(size, 10)""",
        "fixed",
    ),
)
def review_sheet_equidistant(spark, folder):
    return sampling.equidistant_sheet(_fixed(spark, folder))


@_query(
    "gold_sample",
    sql(
        """SELECT row_number() OVER (ORDER BY sha256('43|' || ingest_id), ingest_id) AS line_no, user_id, goods_id,
        comment, '' AS gold FROM (SELECT * FROM scored QUALIFY row_number() OVER
        (PARTITION BY label ORDER BY sha256('42|' || ingest_id), ingest_id) <= 40)""",
        "scored",
    ),
)
def gold_sample(spark, folder):
    sheet = sampling.labelling_sheet(sampling.sample_per_band(_scored(spark, folder)))
    return sheet.withColumn("line_no", F.col("line_no").cast("bigint"))


@_query(
    "short_bands",
    sql(
        f"""SELECT label, COUNT(score) AS cnt FROM (SELECT unnest([{quoted(K.CLASSES)}]) AS label)
        LEFT JOIN scored USING (label) GROUP BY label HAVING COUNT(score) < 400""",
        "scored",
    ),
)
def short_bands(spark, folder):
    return sampling.short_bands(_scored(spark, folder), 400)


@_query(
    "short_bands_empty",
    sql(
        f"""SELECT label, COUNT(score) AS cnt FROM (SELECT unnest([{quoted(K.CLASSES)}]) AS label)
        LEFT JOIN (SELECT * FROM fixed WHERE label <> '{K.NEUTRAL}') USING (label) GROUP BY label
        HAVING COUNT(score) < 40""",
        "fixed",
    ),
)
def short_bands_empty(spark, folder):
    """A table without any row of one band."""
    return sampling.short_bands(_fixed(spark, folder).filter(F.col("label") != K.NEUTRAL))


# --- evaluation --------------------------------------------------------------------------------

_GOLD_COLUMNS = ("user_id", "goods_id", "comment", "gold", "gold_std", "score", "label")


@_query("gold_join", sql(f"SELECT {', '.join(_GOLD_COLUMNS)} FROM gold", "gold"))
def gold_join(spark, folder):
    return _judged(spark, folder, check=True)[0].select(*_GOLD_COLUMNS)


@_query(
    "gold_ambiguous_share",
    sql(
        """SELECT COUNT(*) AS rows_cnt, COUNT(*) FILTER (WHERE gold = '模糊') AS ambiguous,
        round(COUNT(*) FILTER (WHERE gold = '模糊') / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS ambiguous_pct
        FROM gold_sheet""",
        "gold_sheet",
    ),
)
def gold_ambiguous_share(spark, folder):
    return evaluation.ambiguous_share(_gold_sheet(spark, folder))


@_query(
    "gold_leak_guard",
    sql(
        """SELECT ingest_id, user_id, goods_id, label FROM fixed f WHERE NOT EXISTS (SELECT 1 FROM gold g
        WHERE g.user_id = f.user_id AND g.goods_id = f.goods_id AND g.comment = f.comment)""",
        "fixed", "gold",
    ),
)
def gold_leak_guard(spark, folder):
    gold, fixed = _judged(spark, folder)
    kept = evaluation.exclude_gold(fixed, gold)
    return kept.select("ingest_id", "user_id", "goods_id", "label")


@_query(
    "confusion_matrix",
    sql(
        " UNION ALL ".join(
            f"""SELECT CAST({i} AS INTEGER) AS class_no, '{g}' AS gold_class, """
            + ", ".join(
                f"COUNT(*) FILTER (WHERE gold_std = '{g}' AND label = '{p}') AS pred_{name}"
                for p, name in zip(K.CLASSES, ("negative", "neutral", "positive"))
            )
            + " FROM gold"
            for i, g in enumerate(K.CLASSES)
        ),
        "gold",
    ),
)
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_gold(spark, folder))


_CLASS_ROWS = " UNION ALL ".join(
    f"""SELECT '{c}' AS class, COUNT(*) FILTER (WHERE gold_std = '{c}' AND label = '{c}') AS hits,
    COUNT(*) FILTER (WHERE label = '{c}') AS predicted, COUNT(*) FILTER (WHERE gold_std = '{c}') AS support FROM gold"""
    for c in K.CLASSES
)
_CLASS_SCORES = f"""SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (SELECT *,
    COALESCE(hits / NULLIF(CAST(predicted AS DOUBLE), 0), 0) AS p,
    COALESCE(hits / NULLIF(CAST(support AS DOUBLE), 0), 0) AS r FROM ({_CLASS_ROWS}))"""


@_query(
    "class_report",
    sql(
        f"""SELECT class, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, support
        FROM ({_CLASS_SCORES}) UNION ALL
        SELECT 'accuracy', a, a, a, s FROM (SELECT round(SUM(hits) / CAST(SUM(support) AS DOUBLE), 4) AS a,
        CAST(SUM(support) AS BIGINT) AS s FROM ({_CLASS_SCORES})) UNION ALL
        SELECT 'macro avg', round(AVG(p), 4), round(AVG(r), 4), round(AVG(f), 4), CAST(SUM(support) AS BIGINT)
        FROM ({_CLASS_SCORES}) UNION ALL
        SELECT 'weighted avg', round(SUM(p * support) / SUM(support), 4), round(SUM(r * support) / SUM(support), 4),
        round(SUM(f * support) / SUM(support), 4), CAST(SUM(support) AS BIGINT) FROM ({_CLASS_SCORES})""",
        "gold",
    ),
)
def class_report(spark, folder):
    return evaluation.class_report(_gold(spark, folder))


@_query("band_weighted_recall", sql(weighted_recall("label"), "gold", "fixed"))
def band_weighted_recall(spark, folder):
    gold, fixed = _judged(spark, folder)
    return evaluation.band_weighted_recall(gold, evaluation.band_sizes(fixed))


@_query("mcnemar", sql("SELECT * EXCLUDE (z) FROM paired_p", "paired_p"))
def mcnemar(spark, folder):
    return evaluation.mcnemar(_gold(spark, folder))


def _is_negative():
    return F.col("gold_std") == K.NEGATIVE


def _negativity():
    return F.lit(1.0) - F.col("score")


@_query(
    "average_precision",
    sql(
        """SELECT CAST(SUM(hits) AS BIGINT) AS positives, CAST(SUM(n) AS BIGINT) AS rows_cnt,
        round(SUM(hits * (hits_upto / CAST(n_upto AS DOUBLE))) / SUM(hits), 6) AS average_precision FROM steps""",
        "steps",
    ),
)
def average_precision(spark, folder):
    return evaluation.average_precision(_gold(spark, folder), _is_negative(), _negativity())


@_query(
    "pr_curve",
    sql(
        """SELECT round(threshold, 6) AS threshold, round(hits_upto / CAST(n_upto AS DOUBLE), 6) AS precision,
        round(hits_upto / CAST((SELECT SUM(hits) FROM steps) AS DOUBLE), 6) AS recall FROM steps
        UNION ALL SELECT NULL, 1.0, 0.0""",
        "steps",
    ),
)
def pr_curve(spark, folder):
    points = evaluation.precision_recall_curve(_gold(spark, folder), _is_negative(), _negativity())
    return points.withColumn("threshold", F.round("threshold", 6))


@_query(
    "roc_auc",
    sql(
        f"""SELECT COUNT(*) AS rows_cnt, round((SUM(CASE WHEN y THEN rank END) - p * (p + 1) / 2)
        / (p * (COUNT(*) - p)), 6) AS roc_auc FROM (SELECT gold_std = '{K.NEGATIVE}' AS y,
        (rank() OVER (ORDER BY 1 - score) + (COUNT(*) OVER (PARTITION BY 1 - score) - 1) / 2.0)::DOUBLE AS rank,
        CAST((SELECT COUNT(*) FROM gold WHERE gold_std = '{K.NEGATIVE}') AS DOUBLE) AS p FROM gold) GROUP BY p""",
        "gold",
    ),
)
def roc_auc(spark, folder):
    return evaluation.roc_auc(_gold(spark, folder), _is_negative(), _negativity())


@_query(
    "binary_metrics",
    sql(
        f"""SELECT round(ok / n, 6) AS accuracy, round(tp / pp, 6) AS precision, round(tp / ap, 6) AS recall,
        round(2 * tp / (pp + ap), 6) AS f1 FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n,
        CAST(COUNT(*) FILTER (WHERE g AND l) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (WHERE l) AS DOUBLE) AS pp,
        CAST(COUNT(*) FILTER (WHERE g) AS DOUBLE) AS ap, CAST(COUNT(*) FILTER (WHERE g = l) AS DOUBLE) AS ok
        FROM (SELECT gold_std = '{K.NEGATIVE}' AS g, label = '{K.NEGATIVE}' AS l FROM gold))""",
        "gold",
    ),
)
def binary_metrics(spark, folder):
    return evaluation.binary_metrics(_gold(spark, folder), _is_negative(), F.col("label") == K.NEGATIVE)


@_query(
    "both_wrong",
    sql(
        """SELECT user_id, goods_id, comment, gold_std, label, label_b, score FROM gold
        WHERE label <> gold_std AND label_b <> gold_std""",
        "gold",
    ),
)
def both_wrong(spark, folder):
    return evaluation.both_wrong(_gold(spark, folder))


@_query(
    "model_decision",
    sql(
        f"""SELECT *, CASE WHEN gain_points >= 5 AND p_value < 0.05 THEN 'switch' ELSE 'keep' END AS decision FROM (
        SELECT a.f1_w AS baseline_f1_w, b.f1_w AS candidate_f1_w, round((b.f1_w - a.f1_w) * 100, 4) AS gain_points,
        (SELECT p_value FROM paired_p) AS p_value
        FROM ({weighted_recall('label')}) a, ({weighted_recall('label_b')}) b)""",
        "gold", "fixed", "paired_p",
    ),
)
def model_decision(spark, folder):
    gold, fixed = _judged(spark, folder)
    return evaluation.model_decision(
        gold, evaluation.band_sizes(fixed), evaluation.band_sizes(fixed, "label_b")
    )


# --- samples and model preparation -------------------------------------------------------------

_PLACED = """SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY sha256('42|' || id), id) AS k,
    COUNT(*) OVER (PARTITION BY label) AS size FROM features"""


@_query(
    "stratified_split",
    sql(
        f"""SELECT id, label, CAST(k <= train_size AS INTEGER) AS is_train,
        CAST(k <= floor(train_size * least(CAST(1 AS DOUBLE), CAST({K.MAX_FIT_ROWS} AS DOUBLE) / total)) AS INTEGER) AS in_subsample
        FROM (SELECT *, round(size * CAST(0.7 AS DOUBLE)) AS train_size,
        (SELECT round(COUNT(*) * CAST(0.7 AS DOUBLE)) FROM features) AS total FROM ({_PLACED}))""",
        "features",
    ),
)
def stratified_split(spark, folder):
    rows = _dwd(spark, folder).select("id", exploration.is_purchase().alias("label"))
    return sampling.stratified_split(rows)


@_query("fold_ids", sql(f"SELECT id, label, CAST((k - 1) % 5 AS INTEGER) AS fold FROM ({_PLACED})", "features"))
def fold_ids(spark, folder):
    rows = _dwd(spark, folder).select("id", exploration.is_purchase().alias("label"))
    return sampling.fold_ids(rows)


@_query(
    "class_weights",
    sql(
        """SELECT label, cnt, round(CAST((SELECT COUNT(*) FROM features) AS DOUBLE) / (COUNT(*) OVER () * cnt), 6)
        AS weight FROM (SELECT label, COUNT(*) AS cnt FROM features GROUP BY label)""",
        "features",
    ),
)
def class_weights(spark, folder):
    rows = _dwd(spark, folder).select(exploration.is_purchase().alias("label"))
    return learning.class_weights(rows).withColumn("weight", F.round("weight", 6))


@_query(
    "scale_features",
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(AVG({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM features"
            for c in K.FEATURES
        ),
        "features",
    ),
)
def scale_features(spark, folder):
    moments = learning.feature_moments(_features(spark, folder))
    return moments.select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@_query(
    "tfidf_stats",
    sql(
        """SELECT COUNT(*) AS features, CAST(SUM(df) AS BIGINT) AS filled_cells, rows_cnt,
        round(1.0 - SUM(df) / (CAST(rows_cnt AS DOUBLE) * COUNT(*)), 6) AS sparsity
        FROM term_df, (SELECT COUNT(*) AS rows_cnt FROM cleaned) GROUP BY rows_cnt""",
        "term_df", "cleaned",
    ),
)
def tfidf_stats(spark, folder):
    return text.tfidf_stats(_stored_reviews(spark, folder))


@_query(
    "tfidf_weights",
    sql(
        """SELECT ingest_id, term, round(w / norm, 6) AS weight FROM (SELECT *,
        sqrt(SUM(w * w) OVER (PARTITION BY ingest_id)) AS norm
        FROM (SELECT ingest_id, term, tf * (ln(((SELECT COUNT(*) FROM cleaned) + 1) / CAST(df + 1 AS DOUBLE)) + 1) AS w
        FROM term_counts JOIN term_df USING (term)))""",
        "term_counts", "term_df", "cleaned",
    ),
)
def tfidf_weights(spark, folder):
    """Every term of every review with its weight."""
    weighted = text.tfidf_weights(_stored_reviews(spark, folder))
    return weighted.select("ingest_id", F.inline("weights")).withColumn("weight", F.round("weight", 6))


# --- files ---------------------------------------------------------------------------------------

_COMMENT = """CASE WHEN ingest_id % 7 = 0 THEN '第一行' || chr(10) || 'says "' || ingest_id || '"'
    WHEN ingest_id % 7 = 1 THEN 'NA' END"""
_RANK = "row_number() OVER (ORDER BY ingest_id) - 1 AS ingest_id"


@_query(
    "file_behaviour_log",
    sql(f"SELECT * REPLACE ({_COMMENT} AS comment, NULLIF(timestamp, '') AS timestamp, {_RANK}) FROM behaviour", "behaviour"),
)
def file_behaviour_log(spark, folder):
    return roundtrips.behaviour_file(spark, folder)


@_query("file_numbered_log", sql(f"SELECT {_RANK}, user_id, goods_id, behavior, NULLIF(timestamp, '') AS timestamp FROM behaviour", "behaviour"))
def file_numbered_log(spark, folder):
    return roundtrips.numbered_log(spark, folder)


@_query(
    "file_malformed_cells",
    sql("SELECT COUNT(*) AS records FROM behaviour WHERE ingest_id % 50 = 0", "behaviour"),
)
def file_malformed_cells(spark, folder):
    return roundtrips.malformed_cells(spark, folder)


@_query("file_dimension_load", sql("SELECT user_id, face FROM profile", "profile"))
def file_dimension_load(spark, folder):
    return roundtrips.dimension_load(spark, folder)


@_query(
    "file_overwritten_log",
    sql("SELECT COUNT(*) AS rows_cnt, CAST(2 AS INTEGER) AS loads_kept FROM behaviour", "behaviour"),
)
def file_overwritten_log(spark, folder):
    return roundtrips.overwritten_log(spark, folder)


@_query(
    "file_named_tables",
    """SELECT t AS table_name, CAST(n AS INTEGER) AS loads FROM
    (VALUES ('ods_user_behavior', 0), ('dim_user_profile', 1), ('dim_category', 1)) v(t, n)""",
)
def file_named_tables(spark, folder):
    return roundtrips.named_tables(spark, folder)


@_query(
    "file_loaded_rows",
    sql(
        """SELECT 'ods_user_behavior' AS table_name, COUNT(*) AS rows_cnt FROM behaviour UNION ALL
        SELECT 'dim_user_profile', COUNT(*) FROM profile UNION ALL SELECT 'dim_category', COUNT(*) FROM category""",
        "behaviour", "profile", "category",
    ),
)
def file_loaded_rows(spark, folder):
    return roundtrips.loaded_rows(spark, folder)


@_query(
    "file_report",
    sql(
        """SELECT true AS has_mark, 'behavior,cnt' AS line UNION ALL
        SELECT true, behavior || ',' || COUNT(*) FROM behaviour GROUP BY behavior""",
        "behaviour",
    ),
)
def file_report(spark, folder):
    return roundtrips.report_file(spark, reports.frequency(views.behaviour(spark, folder), "behavior").select("behavior", "cnt"))


@_query(
    "file_score_cache",
    sql("SELECT ingest_id, user_id, goods_id, category_id, comment, score, label, score_b, label_b FROM fixed", "fixed"),
)
def file_score_cache(spark, folder):
    return roundtrips.score_cache(spark, text.with_words(views.fixed_predictions(_cleaned(spark, folder))))


@_query("file_gold_sheet", sql("SELECT * FROM gold_sheet", "gold_sheet"))
def file_gold_sheet(spark, folder):
    return roundtrips.gold_file(spark, _gold_sheet(spark, folder))


# --- model arithmetic on fixed inputs ------------------------------------------------------------


@_query(
    "scaled_features",
    sql(
        "SELECT id, label, "
        + ", ".join(
            f"round(({c} - AVG({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END), 6) AS {c}"
            for c in K.FEATURES
        )
        + " FROM features",
        "features",
    ),
)
def scaled_features(spark, folder):
    """Every scaled value of every row."""
    features = _features(spark, folder)
    scaled = learning.scale_features(features, learning.feature_moments(features))
    values = vector_to_array("features")
    return scaled.select("id", "label", *[F.round(values[i], 6).alias(c) for i, c in enumerate(K.FEATURES)])


@_query(
    "cluster_report_fixed",
    sql(
        """SELECT cluster, cnt, round(rate, 6) AS rate,
        CAST(CASE WHEN row_number() OVER (ORDER BY rate DESC, cluster) = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_best
        FROM (SELECT CAST(user_id % 3 AS INTEGER) AS cluster, COUNT(*) AS cnt, AVG(CAST(label AS DOUBLE)) AS rate
        FROM features GROUP BY user_id % 3)""",
        "features",
    ),
)
def cluster_report_fixed(spark, folder):
    """Size and label rate of clusters that are fixed by the user."""
    rows = _dwd(spark, folder).select((F.col("user_id") % 3).cast("int").alias("cluster"), exploration.is_purchase().alias("label"))
    return learning.cluster_report(rows)


@_query("oof_rows", sql(f"SELECT id, label, CAST((k - 1) % 5 AS INTEGER) AS fold FROM ({_PLACED})", "features"))
def oof_rows(spark, folder):
    """Rows, labels and folds of the out-of-fold predictions."""
    return learning.out_of_fold(_prepared(spark, folder)).select("id", "label", "fold")


def _fixed_model(number: int, factor: int, limit: int) -> str:
    """Metrics of predictions and scores that are fixed by the id, one row per metric."""
    return f"""SELECT unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc']) AS metric, unnest([
        round(ok / n, 6), round(CASE WHEN pp = 0 THEN 1.0 ELSE tp / pp END, 6), round(COALESCE(tp / NULLIF(ap, 0), 0), 6),
        round(COALESCE(2 * tp / NULLIF(pp + ap, 0), 0), 6),
        round(COALESCE((ranks - ap * (ap + 1) / 2) / NULLIF(ap * (n - ap), 0), 0.5), 6)]) AS model{number}
        FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (label = p) AS DOUBLE) AS ok,
        CAST(COUNT(*) FILTER (label = 1 AND p = 1) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (p = 1) AS DOUBLE) AS pp,
        CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS ap, CAST(SUM(CASE WHEN label = 1 THEN r END) AS DOUBLE) AS ranks
        FROM (SELECT label, CASE WHEN s >= {limit} THEN 1 ELSE 0 END AS p,
        rank() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0::DOUBLE AS r
        FROM (SELECT label, (id * {factor}) % 100 AS s FROM features)))"""


_FIXED_FOLDS = """SELECT k % 5 AS fold, label, CASE WHEN (id * 7919) % 100 >= 60 THEN 1 ELSE 0 END AS predicted
    FROM (SELECT id, label, id AS k FROM features)"""


@_query(
    "fold_metrics_fixed",
    sql(
        f"""SELECT metric, round(AVG(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (
        SELECT fold, unnest(['accuracy', 'precision', 'recall', 'f1']) AS metric,
        unnest([ok / n, COALESCE(tp / NULLIF(pp, 0), 0), COALESCE(tp / NULLIF(ap, 0), 0), COALESCE(2 * tp / NULLIF(pp + ap, 0), 0)]) AS v
        FROM (SELECT fold, CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (label = predicted) AS DOUBLE) AS ok,
        CAST(COUNT(*) FILTER (label = 1 AND predicted = 1) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (predicted = 1) AS DOUBLE) AS pp,
        CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS ap FROM ({_FIXED_FOLDS}) GROUP BY fold)) GROUP BY metric""",
        "features",
    ),
)
def fold_metrics_fixed(spark, folder):
    """Mean and deviation over folds of the metrics of fixed predictions."""
    rows = _dwd(spark, folder).select(
        (F.col("id") % 5).alias("fold"), exploration.is_purchase().alias("label"),
        F.when(F.col("id") * 7919 % 100 >= 60, 1).otherwise(0).alias("predicted"),
    )
    found = learning.fold_metrics(rows)
    return found.select("metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _fixed_scores(rows: DataFrame, factor: int, limit: int) -> DataFrame:
    place = F.col("id") * factor % 100
    return rows.select("label", (place >= limit).cast("int").alias("predicted"), (place.cast("double") / 100).alias("ranking_score"))


@_query(
    "model_report_fixed",
    sql(
        f"""SELECT a.metric, model1 AS logistic_regression, model2 AS linear_svm, round(v.mean, 6) AS logistic_cross_validated
        FROM ({_fixed_model(1, 7919, 60)}) a JOIN ({_fixed_model(2, 104729, 50)}) b USING (metric)
        LEFT JOIN (SELECT metric, AVG(v) AS mean FROM (SELECT unnest(['accuracy', 'precision', 'recall', 'f1']) AS metric,
        unnest([ok / n, COALESCE(tp / NULLIF(pp, 0), 0), COALESCE(tp / NULLIF(ap, 0), 0), COALESCE(2 * tp / NULLIF(pp + ap, 0), 0)]) AS v
        FROM (SELECT fold, CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (label = predicted) AS DOUBLE) AS ok,
        CAST(COUNT(*) FILTER (label = 1 AND predicted = 1) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (predicted = 1) AS DOUBLE) AS pp,
        CAST(COUNT(*) FILTER (label = 1) AS DOUBLE) AS ap FROM ({_FIXED_FOLDS}) GROUP BY fold)) GROUP BY metric) v USING (metric)""",
        "features",
    ),
)
def model_report_fixed(spark, folder):
    """The side-by-side report of two models whose predictions and scores are fixed by the id."""
    rows = _dwd(spark, folder).select("id", exploration.is_purchase().alias("label"))
    folds = rows.select((F.col("id") % 5).alias("fold"), "label", F.when(F.col("id") * 7919 % 100 >= 60, 1).otherwise(0).alias("predicted"))
    logistic, svm = (learning.evaluate_binary(_fixed_scores(rows, *p)) for p in ((7919, 60), (104729, 50)))
    report = learning.model_report(logistic, svm, learning.fold_metrics(folds))
    return report.withColumn("logistic_cross_validated", F.round("logistic_cross_validated", 6))


# --- fitted models (no SQL twin: iterative) ------------------------------------------------------


def _prepared(spark, folder):
    """Scaled features with their split; the moments come from training rows only."""
    split = sampling.stratified_split(_features(spark, folder))
    return durable(learning.scale_features(split, learning.feature_moments(split.filter("is_train = 1"))))


def _logistic(prepared):
    return learning.fit_logistic(prepared.filter("is_train = 1"))


@_query("lr_binary")
def lr_binary(spark, folder):
    prepared = _prepared(spark, folder)
    return learning.evaluate_binary(learning.predict(_logistic(prepared), prepared.filter("is_train = 0")))


@_query("lr_feature_importance")
def lr_feature_importance(spark, folder):
    return learning.feature_importance(_logistic(_prepared(spark, folder)), spark)


@_query("svm_linear")
def svm_linear(spark, folder):
    prepared = _prepared(spark, folder)
    model = learning.fit_linear_svm(prepared.filter("in_subsample = 1"))
    return learning.evaluate_binary(learning.predict(model, prepared.filter("is_train = 0")))


@_query("kmeans_users")
def kmeans_users(spark, folder):
    return learning.cluster_report(learning.cluster_rows(_prepared(spark, folder)))


@_query("cv_scores")
def cv_scores(spark, folder):
    return learning.cross_validate(_prepared(spark, folder))


@_query("oof_predictions")
def oof_predictions(spark, folder):
    predicted = learning.out_of_fold(_prepared(spark, folder))
    return predicted.select("id", "label", "fold", "predicted", F.round("ranking_score", 6).alias("ranking_score"))


@_query("model_report")
def model_report(spark, folder):
    prepared = _prepared(spark, folder)
    test = prepared.filter("is_train = 0")
    logistic = learning.evaluate_binary(learning.predict(_logistic(prepared), test))
    svm_model = learning.fit_linear_svm(prepared.filter("in_subsample = 1"))
    svm = learning.evaluate_binary(learning.predict(svm_model, test))
    return learning.model_report(logistic, svm, learning.cross_validate(prepared))


@_query("text_classifier")
def text_classifier(spark, folder):
    """Precision and band-weighted figures of the self-labelled classifier on the gold rows."""
    scored = _scored_table(spark, folder)
    sheet = durable(views.gold_sheet(scored, views.labels(spark, folder)))
    model = learning.fit_on_bands(scored, sheet)
    judged = model.predict(evaluation.join_gold(sheet, scored, check=False), "model_label")
    judged = durable(judged.select("gold_std", "model_label"))  # every figure reads them, and the sizes
    sizes = durable(evaluation.band_sizes(model.predict(scored, "model_label"), "model_label"))
    return evaluation.band_weighted_recall(judged, sizes, pred="model_label")


@_query("model_comparison")
def model_comparison(spark, folder):
    """The scorer against the self-labelled classifier, one row per model."""
    scored = _scored_table(spark, folder)
    sheet = durable(views.gold_sheet(scored, views.labels(spark, folder)))
    return comparison.compare_models(scored, sheet).summary


@_query("text_band_counts")
def text_band_counts(spark, folder):
    scored = _scored_table(spark, folder)
    model = learning.fit_on_bands(scored, views.gold_sheet(scored, views.labels(spark, folder)))
    predicted = durable(model.predict(scored, "model_label").select("model_label"))  # counts and total read them
    return reports.frequency(predicted, "model_label")


@_query("text_top_features")
def text_top_features(spark, folder):
    scored = _scored_table(spark, folder)
    model = learning.fit_on_bands(scored, views.gold_sheet(scored, views.labels(spark, folder)))
    return learning.text_top_features(model, scored)


@_query("text_cv_scores")
def text_cv_scores(spark, folder):
    return learning.fold_f1(learning.text_out_of_fold(_gold(spark, folder)))


@_query("text_both_wrong")
def text_both_wrong(spark, folder):
    predicted = learning.text_out_of_fold(_gold(spark, folder))
    return evaluation.both_wrong(predicted, "label", "cv_label")


@_query("lr_pr_curve")
def lr_pr_curve(spark, folder):
    """Precision and recall at every score of the logistic purchase model on test rows."""
    prepared = _prepared(spark, folder)
    predicted = learning.predict(_logistic(prepared), prepared.filter("is_train = 0"))
    return evaluation.precision_recall_curve(predicted, F.col("label") == 1, F.col("ranking_score"))


@_query("svm_pr_curve")
def svm_pr_curve(spark, folder):
    """Precision and recall at every margin of the linear purchase model, fitted to all training rows, on test rows."""
    prepared = _prepared(spark, folder)
    model = learning.fit_linear_svm(prepared.filter("is_train = 1"))
    predicted = learning.predict(model, prepared.filter("is_train = 0"))
    return evaluation.precision_recall_curve(predicted, F.col("label") == 1, F.col("ranking_score"))


@_query("text_pr_curve")
def text_pr_curve(spark, folder):
    """Precision and recall of the self-labelled classifier on the gold rows."""
    scored = _scored_table(spark, folder)
    sheet = durable(views.gold_sheet(scored, views.labels(spark, folder)))
    judged = learning.fit_on_bands(scored, sheet).predict(evaluation.join_gold(sheet, scored, check=False), "model_label")
    judged = durable(judged.select("gold_std", "model_label_negative"))  # the curve and its total read them
    return evaluation.precision_recall_curve(judged, _is_negative(), F.col("model_label_negative"))


# --- stored layers and fitted models, checked ----------------------------------------------------

ONE_DAY = "2024-01-05"


@_query(
    "layer_one_day",
    sql(
        f"""SELECT COUNT(*) AS rows_cnt, COUNT(DISTINCT user_id) AS users, CAST(MIN(event_date) AS VARCHAR) AS first_day_read,
        CAST(MAX(event_date) AS VARCHAR) AS last_day_read, (SELECT COUNT(DISTINCT event_date) FROM dwd) AS days_stored
        FROM dwd WHERE event_date = DATE '{ONE_DAY}'""",
        "dwd",
    ),
)
def layer_one_day(spark, folder):
    """The detail layer written by day; one day is read from that day's files alone."""
    return roundtrips.one_day_of_detail(spark, folder, ONE_DAY)


_SPLIT = f"SELECT *, k <= round(size * CAST(0.7 AS DOUBLE)) AS is_train FROM ({_PLACED})"


@_query(
    "lr_certificate",
    sql(
        f"""SELECT COUNT(*) AS rows_cnt, CAST({len(K.FEATURES)} AS INTEGER) AS features, CAST(1 AS INTEGER) AS at_optimum
        FROM ({_SPLIT}) WHERE is_train""",
        "features",
    ),
)
def lr_certificate(spark, folder):
    """The logistic purchase model, and with it its feature importance, is the optimum of its loss."""
    train = _prepared(spark, folder).filter("is_train = 1")
    return learning.logistic_certificate(learning.fit_logistic(train), train)


@_query(
    "importance_order",
    f"""SELECT CAST({len(K.FEATURES)} AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative, CAST(0 AS BIGINT) AS out_of_order,
    CAST(0 AS BIGINT) AS differing""",
)
def importance_order(spark, folder):
    """Feature importance is the absolute coefficient, largest first, every feature once."""
    model = _logistic(_prepared(spark, folder))
    importance = learning.feature_importance(model, spark).withColumn("_at", F.monotonically_increasing_id())
    own = spark.createDataFrame([(n, float(v)) for n, v in zip(K.FEATURES, model.coefficients)], "feature string, coefficient double")
    both = importance.join(own, "feature", "full").withColumn("before", F.lag("importance").over(W.orderBy("_at")))
    return both.agg(
        F.count_distinct("feature").alias("features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.count_if(F.col("importance") > F.col("before")).alias("out_of_order"),
        F.count_if(~F.coalesce(F.abs("coefficient") == F.col("importance"), F.lit(False))).alias("differing"),
    )


@_query(
    "kmeans_certificate",
    sql(
        """SELECT COUNT(*) AS rows_cnt, CAST(3 AS INTEGER) AS clusters, CAST(0 AS BIGINT) AS misplaced, CAST(1 AS INTEGER) AS centred
        FROM features""",
        "features",
    ),
)
def kmeans_certificate(spark, folder):
    """Every row is in its nearest cluster, and every centre is the mean of its rows."""
    prepared = _prepared(spark, folder)
    return learning.cluster_certificate(learning.fit_clusters(prepared), prepared)


@_query(
    "text_certificate",
    sql(
        """SELECT COUNT(*) AS rows_cnt, CAST(1 AS INTEGER) AS at_optimum FROM scored f WHERE label IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM gold_sheet g WHERE g.user_id = f.user_id AND g.goods_id = f.goods_id AND g.comment = f.comment)""",
        "scored", "gold_sheet",
    ),
)
def text_certificate(spark, folder):
    """The text classifier saw no gold row and is the optimum of its loss."""
    scored = _scored_table(spark, folder)
    gold = views.gold_sheet(scored, views.labels(spark, folder))
    train = durable(evaluation.exclude_gold(scored, gold).select("label", "buckets"))
    return learning.text_certificate(learning.fit_text_classifier(train, "label"), train)


@_query(
    "svm_probability",
    sql(f"SELECT COUNT(*) AS rows_cnt, CAST(0 AS BIGINT) AS violations FROM ({_SPLIT}) WHERE NOT is_train", "features"),
)
def svm_probability(spark, folder):
    """Calibrated probabilities of the margin model on test rows: all within 0 and 1, in the order of the margins."""
    prepared = _prepared(spark, folder)
    model = learning.fit_calibrated_svm(prepared.filter("in_subsample = 1"))
    return learning.calibration_certificate(model.predict(prepared.filter("is_train = 0")))


@_query("term_collisions")
def term_collisions(spark, folder):
    """Terms that share a bucket of the text model with other terms, and how many reviews stand behind each."""
    reviews = _stored_reviews(spark, folder)
    return learning.term_dictionary(reviews).filter("bucket_terms > 1").select("term", "bucket", "df", "bucket_terms", "bucket_df")
