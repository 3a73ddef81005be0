"""Labels, word lists and thresholds that results depend on."""

# --- Fixed values: behaviour codes and their order in reports --------------------------------
BEHAVIOURS = ("pv", "cart", "fav", "buy")
FUNNEL_STAGES = ("pv", "cart", "buy", "fav")

# --- Fixed values: first and last epoch second that convert to a timestamp ---------------------
MIN_EPOCH_SECOND = -62_135_596_800
MAX_EPOCH_SECOND = 32_536_771_199

# --- Fixed values: segment labels by (recency high, frequency high, money high) ---------------
SEGMENTS = {
    (True, True, True): "重要价值客户",
    (True, False, True): "重要发展客户",
    (False, True, True): "重要保持客户",
    (False, False, True): "重要挽留客户",
    (True, True, False): "一般价值客户",
    (True, False, False): "一般发展客户",
    (False, True, False): "一般保持客户",
    (False, False, False): "一般挽留客户",
}
HIGH_VALUE_SEGMENTS = ("重要价值客户", "重要发展客户", "重要保持客户", "重要挽留客户")
SEGMENT_ORDER = (
    "重要价值客户", "重要保持客户", "重要挽留客户", "重要发展客户",
    "一般价值客户", "一般保持客户", "一般挽留客户", "一般发展客户",
)
TILES = 4
HIGH_SCORE = 3

# --- Fixed values: default labels ------------------------------------------------------------
UNKNOWN = "未知"
UNKNOWN_CATEGORY = "未知品类"
NO_COMMENT = "无评论"

# --- Fixed values: cleaning limits -----------------------------------------------------------
PRICE_QUANTILE = 0.99
AMOUNT_RANGE = (0, 100)
HOT_CATEGORIES = (4756105, 4145813, 2355072)
HOT_GOODS_QUANTILE = 0.8
TREND_WINDOW = 7
FORECAST_GROWTH = 0.05
MIN_GROUP_USERS = 100

# --- Fixed values: sentiment bands -----------------------------------------------------------
NEGATIVE, NEUTRAL, POSITIVE = "负面", "中性", "正面"
CLASSES = (NEGATIVE, NEUTRAL, POSITIVE)
BAND_REPORT_ORDER = (POSITIVE, NEUTRAL, NEGATIVE)
NEGATIVE_MAX, NEUTRAL_MAX = 0.2, 0.8
SCORE_RANGE = (-0.01, 1.01)

# --- Fixed values: labels people write in the gold sheet --------------------------------------
AMBIGUOUS = "模糊"
GOLD_LABELS = {"真负面": NEGATIVE, "真中性": NEUTRAL, "真正面": POSITIVE, AMBIGUOUS: AMBIGUOUS}

# --- Fixed values: review job limits ---------------------------------------------------------
MIN_REVIEW_CHARS = 5
TEMPLATE_THRESHOLD = 100
MIN_CATEGORY_REVIEWS = 20
SAMPLE_PER_BAND = 40
SHEET_STRATA = ((-0.01, 0.1), (0.1, 0.2))
SHEET_ROWS_PER_STRATUM = 10
SHEET_CHARS = 80
HISTOGRAM_BINS = 20
SEED = 42

# --- Bound on the labelled rows that the margin model is fitted on ---------------------------
MAX_FIT_ROWS = 100_000

# --- Fixed values: switch the model only above both limits ------------------------------------
DECISION_MIN_GAIN_POINTS = 5.0
DECISION_MAX_P = 0.05
EXACT_TEST_BELOW = 25

# --- Fixed values: shop terms that must stay whole when reviews are tokenised ------------------
DOMAIN_TERMS = (
    "物流", "发货速度", "快递员", "客服", "售后", "性价比", "正品",
    "包装", "退换货", "返修", "赠品", "促销", "京东商城", "实体店",
    "快递小哥", "第三方", "卖家", "买家", "好评", "差评", "给力",
)

# --- Fixed values: words that carry no sentiment -----------------------------------------------
STOP_WORDS = (
    "的", "了", "是", "我", "不", "都", "也", "很", "就", "还", "啊", "吧",
    "吗", "呢", "在", "有", "一个", "这个", "那个", "自己", "什么", "没有",
    "可以", "因为", "所以", "但是", "就是", "觉得", "东西", "京东",
    "买", "收到", "感觉", "知道", "时间", "问题", "地方", "应该", "现在",
    "一直", "不是", "本书", "非常", "真的", "其实", "可能", "还是",
    "时候", "这样", "而且", "比较", "已经", "其他", "这么", "怎么",
    "差评", "好评", "中评",
    "苹果",
    "有点", "一样",
    "效果", "第一次", "以后", "一次", "还有",
)

# --- Fixed values: modelling features, in report order ----------------------------------------
FEATURES = (
    "sex", "browse_goods_types", "total_behavior_count", "goods_hot_score",
    "is_peak_hour", "is_weekend", "user_goods_count", "is_hot_category",
)
