"""Report files of a built warehouse: CSV with a byte-order mark, one folder per report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shoplayers.operators import evaluation, sampling
from shoplayers.plans import reports, reviews
from shoplayers.sources.files import LayerTables, read_gold_csv, write_report

# Reports whose size does not grow with users or events go into one file each.
SMALL: dict[str, Callable[[LayerTables], DataFrame]] = {
    "segment_report": lambda t: reports.segment_report(t.read("ads_rfm_segments")),
    "segment_share": lambda t: reports.segment_share(t.read("ads_rfm_segments")),
    "segment_means": lambda t: reports.segment_means(t.read("ads_rfm_segments")),
    "high_value_by_occupation": lambda t: reports.high_value_by_occupation(
        t.read("ads_rfm_segments"), t.read("dim_user_profile")
    ),
    "high_value_share_by_occupation": lambda t: reports.high_value_share_by_occupation(
        t.read("ads_rfm_segments"), t.read("dim_user_profile")
    ),
    "user_funnel": lambda t: reports.user_funnel(t.read("dwd_user_behavior")),
    "daily_active_users": lambda t: reports.daily_active_users(t.read("dws_user_day")),
}
# One row per user: many files.
WIDE: dict[str, Callable[[LayerTables], DataFrame]] = {
    "validation_wide": lambda t: reports.validation_wide(t.read("ads_rfm_segments"), t.read("dim_user_profile")),
}


def publish_warehouse_reports(tables: LayerTables, folder: str) -> list[str]:
    """Write every report of the behaviour warehouse under `folder`; returns their names."""
    for name, build in SMALL.items():
        write_report(build(tables), f"{folder}/{name}")
    for name, build in WIDE.items():
        write_report(build(tables), f"{folder}/{name}", single_file=False)
    return [*SMALL, *WIDE]


def publish_review_reports(tables: LayerTables, folder: str) -> list[str]:
    """Write the reports of the stored scored reviews, with a blind sheet to label."""
    scored = tables.read("scored_reviews")
    written = {
        "sentiment_distribution": reviews.sentiment_distribution(scored),
        "category_negative_rate": reviews.category_negative_rate(scored, tables.read("dim_category")),
        "labelling_sheet": sampling.labelling_sheet(sampling.sample_per_band(scored)),
        "review_sheet": sampling.equidistant_sheet(scored),
        "short_bands": sampling.short_bands(scored),
    }
    for name, report in written.items():
        write_report(report, f"{folder}/{name}")
    write_report(reviews.negative_reviews(scored), f"{folder}/negative_reviews", single_file=False)
    return [*written, "negative_reviews"]


def publish_gold_reports(tables: LayerTables, gold_path: str, folder: str) -> list[str]:
    """Judge the stored scores on the filled-in sheet and write the figures."""
    scored = tables.read("scored_reviews")
    gold = read_gold_csv(scored.sparkSession, gold_path)
    judged = evaluation.join_gold(gold, scored)
    written = {
        "ambiguous_share": evaluation.ambiguous_share(gold),
        "confusion_matrix": evaluation.confusion_matrix(judged),
        "class_report": evaluation.class_report(judged),
        "band_weighted_recall": evaluation.band_weighted_recall(judged, evaluation.band_sizes(scored)),
    }
    for name, report in written.items():
        write_report(report, f"{folder}/{name}")
    return list(written)
