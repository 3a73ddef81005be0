import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplayers import constants as K
from shoplayers.plans import exploration, reports, warehouse
from shoplayers.sources.files import LayerTables

ODS = (
    "ingest_id long, user_id long, goods_id long, category_id long, behavior string, timestamp string, sex int, "
    "address string, device string, price decimal(12,2), amount int, comment string"
)
DAY = 1717200000  # 2024-06-01 00:00 UTC


def ods(spark, *rows):
    """Rows of (user, goods, behaviour, seconds, price, amount)."""
    full = [
        (i, user, goods, goods % 3, behaviour, stamp, user % 2, None, None, None if price is None else Decimal(price), amount, None)
        for i, (user, goods, behaviour, stamp, price, amount) in enumerate(rows)
    ]
    return spark.createDataFrame(full, ODS)


@pytest.fixture()
def log(spark):
    return ods(
        spark,
        (1, 1, "pv", str(DAY), None, None),
        (1, 1, "PV ", str(DAY + 3600), None, None),
        (1, 1, "buy", str(DAY + 7200), "10.50", 2),
        (1, 2, "buy", str(DAY + 86400), None, 1),
        (2, 1, "cart", str(DAY), None, None),
        (2, 1, "error", str(DAY), None, None),
        (2, 1, "pv", "bad", None, None),
        (2, 1, "pv", None, None, None),
        (2, 1, None, str(DAY), None, None),
        (3, 3, "fav", str(DAY * 1000), None, None),
    )


def test_detail_layer_and_quarantine(spark, log):
    detail = warehouse.build_dwd(log).collect()
    assert [r["id"] for r in detail] == [0, 1, 2, 3, 4]
    assert detail[1]["behavior"] == "pv" and detail[1]["event_time"] == dt.datetime(2024, 6, 1, 1)
    assert detail[3]["event_date"] == dt.date(2024, 6, 2) and detail[2]["event_hour"] == 2
    rejected = {r["ingest_id"]: r["reason"] for r in warehouse.quarantine(log).collect()}
    assert rejected == {5: "behavior", 6: "timestamp", 7: "timestamp", 8: "behavior", 9: "timestamp"}


def test_zone_changes_the_date(spark, log):
    detail = warehouse.build_dwd(log, "America/New_York").collect()
    assert detail[0]["event_date"] == dt.date(2024, 5, 31) and detail[0]["event_hour"] == 20


def test_user_day_and_raw_scores(spark, log):
    days = {(r["user_id"], r["event_date"].day): r for r in warehouse.build_user_day(warehouse.build_dwd(log)).collect()}
    first = days[(1, 1)]
    assert (first["pv_cnt"], first["cart_cnt"], first["fav_cnt"], first["buy_cnt"]) == (2, 0, 0, 1)
    assert first["buy_amount"] == Decimal("21.00") and first["is_buyer"] == 1 and first["is_active"] == 1
    assert days[(1, 2)]["buy_amount"] == 0  # a purchase without a price
    assert days[(2, 1)]["is_buyer"] == 0
    raw = warehouse.build_rfm_raw(warehouse.build_user_day(warehouse.build_dwd(log)), "2024-06-04").collect()
    assert [tuple(r) for r in raw] == [(1, 2, 2, Decimal("21.00"))]


def test_tile_sizes_and_segments(spark):
    raw = spark.createDataFrame(
        [(i, i % 3, 1 + i % 2, Decimal(i * 7 % 11)) for i in range(1, 12)],
        "user_id long, r_days int, f_freq long, m_amount decimal(14,2)",
    )
    segments = warehouse.build_rfm_segments(warehouse.build_rfm_scores(raw)).collect()
    assert len(segments) == 11 and all(r["user_segment"] for r in segments)
    for score in ("r_score", "f_score", "m_score"):
        sizes = [sum(r[score] == t for r in segments) for t in range(1, 5)]
        assert sizes == [3, 3, 3, 2]
    by_user = {r["user_id"]: r for r in segments}
    assert {r["user_id"]: (r["r_days"], r["f_freq"], r["m_amount"]) for r in raw.collect()} == {
        u: (r["r_days"], r["f_freq"], r["m_amount"]) for u, r in by_user.items()
    }
    best = [u for u, r in by_user.items() if r["r_score"] == 4]
    assert all(by_user[u]["r_days"] == 0 for u in best)
    shuffled = warehouse.build_rfm_scores(raw.repartition(7)).collect()
    assert sorted(map(tuple, shuffled)) == sorted(map(tuple, warehouse.build_rfm_scores(raw).collect()))


def test_reconciliation_has_no_difference(spark, log):
    detail = warehouse.build_dwd(log)
    rows = reports.totals_reconciliation(detail, warehouse.build_user_day(detail)).collect()
    assert len(rows) == 5 and all(r["diff"] == 0 for r in rows)


def test_funnel(spark, log):
    rows = reports.user_funnel(warehouse.build_dwd(log)).orderBy("stage_no").collect()
    assert [(r["stage"], r["users"]) for r in rows] == [("pv", 1), ("cart", 1), ("buy", 1), ("fav", 0)]
    assert [r["overall_pct"] for r in rows] == [100.0, 100.0, 100.0, 0.0]
    empty = reports.user_funnel(warehouse.build_dwd(log).limit(0)).orderBy("stage_no").collect()
    assert [r["step_pct"] for r in empty] == [100.0, 0.0, 0.0, 0.0]


def segments_frame(spark):
    names = list(K.SEGMENTS.values())
    rows = [(i, i, i + 1, Decimal(i), 1, 1, 1, names[i % 3]) for i in range(7)]
    return spark.createDataFrame(
        rows,
        "user_id long, r_days int, f_freq long, m_amount decimal(14,2), r_score int, f_score int, m_score int, user_segment string",
    )


def test_segment_reports(spark):
    segments = segments_frame(spark)
    report = reports.segment_report(segments).collect()
    assert sum(r["users"] for r in report) == 7
    assert sum(r["pct"] for r in report) == pytest.approx(100, abs=0.02)
    assert [r["avg_m_amount"] for r in report] == sorted((r["avg_m_amount"] for r in report), reverse=True)
    order = [r["user_segment"] for r in reports.segment_share(segments).collect()]
    assert order == [s for s in K.SEGMENT_ORDER if s in order]
    flat = reports.segment_means_scaled(segments.filter("user_id = 1")).first()
    assert (flat["r_scaled"], flat["f_scaled"], flat["m_scaled"]) == (0.0, 0.0, 0.0)


def test_occupations(spark):
    segments = segments_frame(spark)
    profiles = spark.createDataFrame([(i, None if i % 2 else "x") for i in range(20)] + [(90, K.UNKNOWN)], "user_id long, face string")
    top = {(r["occupation"], r["high_value_users"]) for r in reports.high_value_by_occupation(segments, profiles).collect()}
    assert top == {("x", 4), (K.UNKNOWN, 3)}
    shares = reports.high_value_share_by_occupation(segments, profiles, 10).collect()
    assert [(r["occupation"], r["total_users"], r["high_value"], r["high_value_pct"]) for r in shares] == [
        ("x", 10, 4, 40.0), (None, 10, 3, 30.0),
    ]
    wide = reports.validation_wide(segments, profiles)
    assert wide.columns[0] == "face" and wide.count() == 21
    assert tuple(reports.validation_totals(wide).first())[:4] == (21, 2, 21, 7)


def test_fixed_order_frequency(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",)], "v string")
    rows = [(r["v"], r["cnt"]) for r in reports.frequency_in_order(df, "v", ["c", "b", "a"]).collect()]
    assert rows == [("c", 1), ("b", 0), ("a", 2)]


def test_conversion_reports(spark, log):
    detail = warehouse.build_dwd(log)
    trend = exploration.daily_conversion(detail).orderBy("event_date").collect()
    assert [r["conversion_rate"] for r in trend] == [0.25, 1.0]
    assert trend[1]["trailing_mean"] == pytest.approx(0.625)
    forecast = exploration.conversion_forecast(detail).first()
    assert forecast["predicted_rate"] == pytest.approx(0.625 * 1.05)
    assert tuple(exploration.conversion_forecast(detail.limit(0)).first()) == (0.0, 0.0)
    lift = exploration.peak_lift(detail).first()
    assert lift["peak_hour"] == 0 and lift["peak_rate"] == pytest.approx(1 / 3, abs=1e-6)


def test_features_by_hand(spark, log):
    rows = {r["id"]: r for r in exploration.model_features(warehouse.build_dwd(log), [1]).collect()}
    assert [rows[i]["user_goods_count"] for i in (0, 1, 2, 3, 4)] == [1, 2, 3, 1, 1]
    assert rows[0]["total_behavior_count"] == 4 and rows[0]["browse_goods_types"] == 2
    assert rows[0]["goods_hot_score"] == 4 and rows[3]["goods_hot_score"] == 1
    assert rows[0]["is_hot_category"] == 1 and rows[3]["is_hot_category"] == 0
    assert [rows[i]["label"] for i in (0, 2, 3)] == [0, 1, 1]
    assert all(rows[i]["is_weekend"] == 1 for i in rows)  # 1 and 2 June 2024


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(i, float(i * i) if i % 4 else None) for i in range(1, 30)], "a long, b double")
    got = {r["column_name"]: r for r in exploration.describe_numeric(df, ["a", "b"]).collect()}
    expected = df.toPandas().describe().round(2)
    names = {"n": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}
    for column in ("a", "b"):
        for ours, theirs in names.items():
            assert got[column][ours] == pytest.approx(expected[column][theirs], abs=0.011)


def test_checks_read_no_layer_again(spark, tmp_path):
    """Rows, NULLs and totals are known from the jobs that wrote the layers."""
    tables = LayerTables(spark, str(tmp_path / "layers"))
    rows = spark.createDataFrame([(1, None, 3), (None, "x", 4), (1, "y", 5)], "a int, b string, c int")
    measures = {"null:a": F.count_if(F.col("a").isNull()), "total": F.sum("c")}
    assert tables.write(rows, "t", measures=measures) == 3
    assert tables.observed["t"] == {"rows": 3, "null:a": 1, "total": 12}
    assert tables.write(rows.limit(0), "t", "a", measures) == 0
    with pytest.raises(ValueError, match="NULLs in {'a': 1}"):
        tables.observed["t"]["null:a"] = 1
        warehouse.check_constraints(tables, {"t": 3})


def test_lost_totals_are_reported(spark, tmp_path):
    tables = LayerTables(spark, str(tmp_path / "layers"))
    totals = {f"total:{b}": 1 for b in ("pv", "cart", "fav", "buy", "gmv")}
    tables.observed = {"dwd_user_behavior": totals, "dws_user_day": totals | {"total:buy": 2}}
    built = {"ods_user_behavior": 5, "dwd_user_behavior": 4, "dwd_quarantine": 1, "dws_user_day": 2}
    with pytest.raises(ValueError, match="total:buy"):
        warehouse.check_layers(tables, built)
    with pytest.raises(ValueError, match="quarantine"):
        warehouse.check_layers(tables, built | {"dwd_quarantine": 0})
