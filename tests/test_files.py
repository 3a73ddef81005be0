import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shoplayers.functions.columns import clean_label
from shoplayers.plans import warehouse
from shoplayers.sources import quoted, schemas
from shoplayers.sources.files import (
    LayerTables, Source, cache_scores, malformed_records, read_csv, read_gold_csv, standard_sources, write_report,
)

DAY = 1717200000


@pytest.fixture()
def folder(tmp_path):
    header = "user_id,goods_id,category_id,behavior,timestamp,sex,address,device,price,amount,comment\r\n"
    lines = [
        f'1,10,100,pv,{DAY},1,北京,手机,,,"第一行\n第二行"',
        f"1,10,100,buy,{DAY + 60},1,北京,手机,12.50,2,NA",
        f"2,11,101,fav,{DAY + 90000},0,,,,,",
        "2,11,101,pv,坏,0,,,,,",
    ]
    (tmp_path / "behaviour.csv").write_bytes((header + "\r\n".join(lines) + "\r\n").encode("gb18030"))
    (tmp_path / "comments.csv").write_text("user_id,goods_id,category_id,comment\n1,10,100,物流很快，好评\n", "utf-8-sig")
    (tmp_path / "categories.csv").write_text(
        "category_id,category_count,category_label\n100,3,手机\n100,4,重复\n101,2,水果\n", "utf-8-sig"
    )
    (tmp_path / "profiles.csv").write_text("user_id,face\n1,　农民 / 种植户 \n1,学生\n2,\n", "utf-8-sig")
    return str(tmp_path)


def sources_in(folder):
    log, *others = standard_sources(*[f"{folder}/{name}.csv" for name in ("behaviour", "comments", "categories", "profiles")])
    return [replace(log, multi_line=True), *others]


def test_gb18030_with_quoted_line_break(spark, folder):
    rows = read_csv(spark, f"{folder}/behaviour.csv", schemas.BEHAVIOUR_FILE, "GB18030", multi_line=True)
    rows = rows.orderBy("ingest_id").collect()
    assert len(rows) == 4
    assert rows[0]["comment"] == "第一行\n第二行" and rows[0]["address"] == "北京"
    assert rows[1]["comment"] == "NA" and str(rows[1]["price"]) == "12.50"
    assert rows[2]["address"] is None and rows[3]["timestamp"] == "坏"


def test_byte_order_mark_is_not_part_of_the_header(spark, folder):
    row = read_csv(spark, f"{folder}/comments.csv", schemas.COMMENT_FILE).first()
    assert row["user_id"] == 1 and row["comment"] == "物流很快，好评"


def test_load_replaces_and_only_loads_named_tables(spark, folder, tmp_path):
    tables = LayerTables(spark, str(tmp_path / "layers"))
    sources = sources_in(folder)
    assert tables.load(sources, only={"dim_user_profile"}) == {"dim_user_profile": 2}
    assert tables.loads("ods_user_behavior") == []
    assert tables.load(sources) == {"ods_user_behavior": 4, "ods_comment": 1, "dim_category": 2, "dim_user_profile": 2}
    tables.load(sources)
    counts = {r["table_name"]: r["rows_cnt"] for r in tables.row_counts([s.table for s in sources]).collect()}
    assert counts == {"ods_user_behavior": 4, "ods_comment": 1, "dim_category": 2, "dim_user_profile": 2}
    faces = {r["user_id"]: r["face"] for r in tables.read("dim_user_profile").collect()}
    assert faces == {1: "农民/种植户", 2: None}
    assert {r["category_label"] for r in tables.read("dim_category").collect()} == {"手机", "水果"}


def test_failed_load_leaves_the_table_as_it_was(spark, folder, tmp_path):
    tables = LayerTables(spark, str(tmp_path / "layers"))
    tables.load(sources_in(folder), only={"dim_category"})
    broken = tables.read("dim_category").withColumn("category_id", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        tables.write(broken, "dim_category")
    assert tables.read("dim_category").count() == 2


def test_missing_table_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        LayerTables(spark, str(tmp_path)).read("nothing")


def test_whole_warehouse_from_files(spark, folder, tmp_path):
    tables = LayerTables(spark, str(tmp_path / "layers"))
    counts = warehouse.build_warehouse(tables, sources_in(folder), "2024-06-04")
    assert counts["dwd_quarantine"] == 1 and counts["dwd_user_behavior"] == 3 and counts["dws_user_day"] == 2 and counts["ads_rfm_segments"] == 1
    day = warehouse.one_user(tables.read("dws_user_day"), 1).first()
    assert day["event_date"] == dt.date(2024, 6, 1) and float(day["buy_amount"]) == 25.0
    plan = tables.read("dwd_user_behavior").filter("event_date = DATE'2024-06-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_report_has_a_byte_order_mark(spark, tmp_path):
    path = tmp_path / "report"
    write_report(spark.createDataFrame([("重要", 1)], "segment string, users int"), str(path))
    files = [f for f in path.iterdir() if f.suffix == ".csv"]
    assert len(files) == 1
    assert files[0].read_bytes().startswith(b"\xef\xbb\xbf")
    assert files[0].read_text("utf-8-sig").splitlines() == ["segment,users", "重要,1"]


def test_score_cache_drops_helpers(spark, tmp_path):
    tables = LayerTables(spark, str(tmp_path))
    scored = spark.createDataFrame([(1, "x", ["x"], "x", 0.1)], "ingest_id long, comment string, words array<string>, norm string, score double")
    assert cache_scores(scored, tables) == 1
    assert tables.read("scored_reviews").columns == ["ingest_id", "comment", "score"]


def test_gold_sheet_types(spark, tmp_path):
    (tmp_path / "gold.csv").write_text('user_id,goods_id,comment,gold\n1,2,"a, b",真负面\n', "utf-8-sig")
    sheet = read_gold_csv(spark, str(tmp_path / "gold.csv"))
    assert sheet.dtypes[0] == ("user_id", "bigint") and sheet.first()["comment"] == "a, b"


def test_cleaners_apply_to_their_column(spark, folder, tmp_path):
    source = Source("p", f"{folder}/profiles.csv", schemas.PROFILE_FILE, cleaners={"face": clean_label})
    tables = LayerTables(spark, str(tmp_path / "l"))
    assert tables.load([source]) == {"p": 3}  # without keys nothing is deduplicated


def test_reviews_from_files_to_scored_table(spark, folder, tmp_path):
    from shoplayers.plans.reviews import build_scored_reviews, sentiment_distribution

    lines = "".join(f"{i},10,100,{'物流很快好评给力' if i % 2 else '包装破损客服很差'}{i}\n" for i in range(20))
    (tmp_path / "comments.csv").write_text("user_id,goods_id,category_id,comment\n" + lines, "utf-8-sig")
    tables = LayerTables(spark, str(tmp_path / "layers"))
    tables.load(sources_in(folder), only={"ods_comment"})
    marks = tables.read("ods_comment").select("ingest_id", (F.col("user_id") % 2).cast("int").alias("is_positive"))
    assert build_scored_reviews(tables, marks.filter("is_positive IS NOT NULL")) == 20
    counts = {r["label"]: r["cnt"] for r in sentiment_distribution(tables.read("scored_reviews")).collect()}
    assert counts == {"正面": 10, "中性": 0, "负面": 10}


def test_first_row_follows_file_names_not_sizes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("user_id,face\n1,small file\n")
    (tmp_path / "in" / "b.csv").write_text("user_id,face\n" + "".join(f"{i},large file\n" for i in range(5000)))
    rows = read_csv(spark, str(tmp_path / "in"), schemas.PROFILE_FILE)
    assert [r["ingest_id"] for r in rows.orderBy("ingest_id").collect()] == list(range(5001))
    assert rows.orderBy("ingest_id").first()["face"] == "small file"
    tables = LayerTables(spark, str(tmp_path / "layers"))
    tables.load([Source("p", str(tmp_path / "in"), schemas.PROFILE_FILE, keys=("user_id",))])
    assert tables.read("p").filter("user_id = 1").first()["face"] == "small file"


def test_numbers_follow_places_when_a_file_is_split(spark, tmp_path):
    (tmp_path / "big.csv").write_text("user_id,face\n" + "".join(f"{i},row {i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = read_csv(spark, str(tmp_path / "big.csv"), schemas.PROFILE_FILE)
        assert rows.rdd.getNumPartitions() > 1
        assert rows.filter("ingest_id <> user_id").count() == 0 and rows.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_malformed_cells_leave_a_trace(spark, tmp_path):
    (tmp_path / "p.csv").write_text("user_id,face\n1,a\nx,b\n3,c\n")
    found = malformed_records(spark, str(tmp_path / "p.csv"), schemas.PROFILE_FILE)
    assert [r["record"] for r in found.collect()] == ["x,b"] and found.count() == 1


def test_old_loads_are_removed(spark, folder, tmp_path):
    tables = LayerTables(spark, str(tmp_path / "layers"), keep_loads=2)
    for _ in range(4):
        tables.load(sources_in(folder), only={"dim_category"})
    assert len(tables.loads("dim_category")) == 2 and tables.read("dim_category").count() == 2


def test_broken_constraints_stop_the_build(spark, folder, tmp_path):
    header = (tmp_path / "categories.csv").read_text("utf-8-sig")
    (tmp_path / "categories.csv").write_text(header + ",5,no id\n", "utf-8-sig")
    with pytest.raises(ValueError, match="dim_category"):
        warehouse.build_warehouse(LayerTables(spark, str(tmp_path / "layers")), sources_in(folder), "2024-06-04")


def test_all_reports_are_written(spark, folder, tmp_path):
    from shoplayers.plans import publish
    from shoplayers.plans.reviews import build_scored_reviews

    lines = "".join(f"{i},10,100,{'物流很快好评给力' if i % 2 else '包装破损客服很差'}{i}\n" for i in range(20))
    (tmp_path / "comments.csv").write_text("user_id,goods_id,category_id,comment\n" + lines, "utf-8-sig")
    tables = LayerTables(spark, str(tmp_path / "layers"))
    warehouse.build_warehouse(tables, sources_in(folder), "2024-06-04")
    marks = tables.read("ods_comment").select("ingest_id", (F.col("user_id") % 2).cast("int").alias("is_positive"))
    build_scored_reviews(tables, marks)
    out = tmp_path / "reports"
    (tmp_path / "gold.csv").write_text(
        "user_id,goods_id,comment,gold\n1,10,物流很快好评给力1,真正面\n2,10,包装破损客服很差2,真负面\n", "utf-8-sig"
    )
    names = publish.publish_warehouse_reports(tables, str(out)) + publish.publish_review_reports(tables, str(out))
    names += publish.publish_gold_reports(tables, str(tmp_path / "gold.csv"), str(out))
    for name in names:
        files = [f for f in (out / name).iterdir() if f.suffix == ".csv"]
        assert files and all(f.read_bytes().startswith(b"\xef\xbb\xbf") for f in files), name


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def odd_rows(n, seed):
    """Cells with line breaks, quotes and Chinese text; some longer than a block."""
    rng = random.Random(seed)
    parts = ["第一行", "\n", '"', ",", "\r\n", " x ", "é", "\n\n", "''", '"\n"']
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]
    texts[n // 3] = "长\n" * 4000
    return [(i, i * 7, 100 + i % 3, text) for i, text in enumerate(texts)]


def write_rows(path, rows, encoding, end="\n"):
    quoted = lambda text: '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') else text
    lines = ["user_id,goods_id,category_id,comment"] + [f"{a},{b},{c},{quoted(text)}" for a, b, c, text in rows]
    path.write_bytes((end.join(lines) + end).encode(encoding))


@pytest.mark.parametrize("encoding, end", [("GB18030", "\n"), ("UTF-8", "\r\n")])
def test_a_multi_line_file_is_read_by_many_tasks(spark, tmp_path, small_blocks, encoding, end):
    rows = odd_rows(1500, 3)
    write_rows(tmp_path / "comments.csv", rows, encoding, end)
    assert (tmp_path / "comments.csv").stat().st_size > 4 * 4096
    found = read_csv(spark, str(tmp_path / "comments.csv"), schemas.COMMENT_FILE, encoding, multi_line=True).collect()
    expected = [(i, *row[:3], row[3] or None) for i, row in enumerate(rows)]
    assert sorted(tuple(r) for r in found) == expected
    records = quoted.read_records(spark, str(tmp_path / "comments.csv"))
    blocks = records.select("block").distinct().count()
    assert blocks >= 4
    shuffled = quoted.read_records(spark, str(tmp_path / "comments.csv"), broadcast_bytes=0)
    key = ["block", "nth", "record"]
    assert sorted(map(tuple, shuffled.select(key).collect())) == sorted(map(tuple, records.select(key).collect()))


def test_several_multi_line_files_are_numbered_in_order(spark, tmp_path, small_blocks):
    rows = odd_rows(600, 5)
    for name, part in (("a", rows[:100]), ("b", rows[100:101]), ("c", []), ("d", rows[101:])):
        write_rows(tmp_path / f"{name}.csv", part, "UTF-8")
    found = read_csv(spark, str(tmp_path), schemas.COMMENT_FILE, multi_line=True).collect()
    assert sorted(tuple(r) for r in found) == [(i, *row[:3], row[3] or None) for i, row in enumerate(rows)]


def test_an_empty_multi_line_file(spark, tmp_path):
    (tmp_path / "none.csv").write_bytes(b"")
    assert read_csv(spark, str(tmp_path / "none.csv"), schemas.COMMENT_FILE, multi_line=True).count() == 0


def test_numbering_moves_no_rows(spark, tmp_path, small_blocks):
    write_rows(tmp_path / "plain.csv", [(i, i, i, f"row {i}") for i in range(3000)], "UTF-8")
    rows = read_csv(spark, str(tmp_path / "plain.csv"), schemas.COMMENT_FILE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert [r["user_id"] for r in rows.orderBy("ingest_id").collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
