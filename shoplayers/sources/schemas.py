"""Column types of the source files and layer tables, and their declared constraints."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(14, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


BEHAVIOUR_FILE = _struct(
    ("user_id", T.LongType()), ("goods_id", T.LongType()), ("category_id", T.LongType()),
    ("behavior", T.StringType()), ("timestamp", T.StringType()), ("sex", T.IntegerType()),
    ("address", T.StringType()), ("device", T.StringType()), ("price", MONEY),
    ("amount", T.IntegerType()), ("comment", T.StringType()),
)
COMMENT_FILE = _struct(
    ("user_id", T.LongType()), ("goods_id", T.LongType()), ("category_id", T.LongType()),
    ("comment", T.StringType()),
)
CATEGORY_FILE = _struct(
    ("category_id", T.LongType()), ("category_count", T.IntegerType()), ("category_label", T.StringType()),
)
PROFILE_FILE = _struct(("user_id", T.LongType()), ("face", T.StringType()))
GOLD_FILE = _struct(
    ("user_id", T.LongType()), ("goods_id", T.LongType()), ("comment", T.StringType()), ("gold", T.StringType()),
)

# Columns that must not be NULL, per table.
NOT_NULL = {
    "ods_user_behavior": ("user_id", "goods_id", "category_id", "behavior"),
    "dim_category": ("category_id",),
    "dim_user_profile": ("user_id",),
    "dwd_user_behavior": (
        "id", "user_id", "goods_id", "category_id", "behavior", "event_time", "event_date", "event_hour",
    ),
    "dws_user_day": (
        "user_id", "event_date", "pv_cnt", "cart_cnt", "fav_cnt", "buy_cnt", "buy_amount", "is_active", "is_buyer",
    ),
    "ads_rfm_segments": (
        "user_id", "r_days", "f_freq", "m_amount", "r_score", "f_score", "m_score", "user_segment",
    ),
}

# Unique keys, per table.
KEYS = {
    "dim_category": ("category_id",),
    "dim_user_profile": ("user_id",),
    "dwd_user_behavior": ("id",),
    "dws_user_day": ("user_id", "event_date"),
    "ads_rfm_segments": ("user_id",),
}
