"""Review insight: one scored row per reviewed booking, rescored on new text only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.values import sha256
from tidewell.operators.latest import first_by, top
from tidewell.operators.scoring import Scorer, sentiment_label, theme_label

INSIGHT_COLUMNS = [
    "booking_id", "review_hash", "sentiment_label", "complaint_category", "review_summary",
    "sentiment_result", "classification_result", "model_source", "processed_at",
]


def backfill_candidates(bookings: DataFrame, limit: int | None = None) -> DataFrame:
    """Completed reviews of the latest bookings; with a `limit` only the newest."""
    reviewed = bookings.filter(F.col("review_text").isNotNull() & (F.col("booking_status") == "COMPLETED"))
    newest = top(reviewed.select("booking_id", "review_text", "booking_created_at"),
                 [F.col("booking_created_at").desc_nulls_last(), F.col("booking_id")], limit)
    return newest.select("booking_id", "review_text", sha256(F.col("review_text")).alias("review_hash"))


def arriving_candidates(snapshots: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Latest reviewed snapshot per booking of a batch, whatever its status."""
    reviewed = snapshots.filter(F.col("booking_id").isNotNull() & F.col("review_text").isNotNull())
    hashed = reviewed.select("booking_id", "review_text", "record_updated_at", *keep,
                             sha256(F.col("review_text")).alias("review_hash"))
    order = [F.col("record_updated_at").desc_nulls_last(), F.col("review_hash")]
    return first_by(hashed, ["booking_id"], order).drop("record_updated_at")


def changed_reviews(candidates: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Candidates whose text has not been scored yet, found before any scoring."""
    if existing is None:
        return candidates
    return candidates.join(existing.select("booking_id", "review_hash"), ["booking_id", "review_hash"], "left_anti")


def score_reviews(changed: DataFrame, scorer: Scorer, model_source: str, now: Column | None = None) -> DataFrame:
    moment = F.current_timestamp() if now is None else now
    return scorer(changed).select(
        "booking_id", "review_hash",
        sentiment_label().alias("sentiment_label"),
        theme_label().alias("complaint_category"),
        F.lit(None).cast("string").alias("review_summary"),
        "sentiment_result", "classification_result",
        F.lit(model_source).alias("model_source"),
        moment.alias("processed_at"),
    )


def upsert_reviews(target: DataFrame | None, scored: DataFrame, columns: list[str] = INSIGHT_COLUMNS) -> DataFrame:
    """Scored rows replace or join the target; each is computed once."""
    if target is None:
        return scored.select(*columns)
    old = target.select(F.col("booking_id").alias("_old_id"), F.struct(*columns).alias("old"))
    new = scored.select(F.col("booking_id").alias("_new_id"), F.struct(*columns).alias("new"))
    merged = old.join(new, F.col("_old_id") == F.col("_new_id"), "full_outer")
    return merged.select(F.coalesce("new", "old").alias("r")).select("r.*")


def backfill_reviews(
    target: DataFrame | None, bookings: DataFrame, scorer: Scorer, model_source: str,
    limit: int | None = None, now: Column | None = None,
) -> DataFrame:
    changed = changed_reviews(backfill_candidates(bookings, limit), target)
    return upsert_reviews(target, score_reviews(changed, scorer, model_source, now))


def enrich_new_reviews(
    target: DataFrame | None, snapshots: DataFrame, scorer: Scorer, model_source: str, now: Column | None = None
) -> DataFrame:
    changed = changed_reviews(arriving_candidates(snapshots), target)
    return upsert_reviews(target, score_reviews(changed, scorer, model_source, now))


def score_agreement(scored: DataFrame, expected: str, predicted: str) -> DataFrame:
    """Confusion counts, and the share of rows on the diagonal."""
    counts = scored.groupBy(F.col(expected).alias("expected"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("rows"))
    hits = F.sum(F.when(F.col("expected").eqNullSafe(F.col("predicted")), F.col("rows")).otherwise(0))
    every = Window.partitionBy()  # over one row per pair of labels
    return counts.withColumn("accuracy", F.round(hits.over(every) / F.sum("rows").over(every), 4))
