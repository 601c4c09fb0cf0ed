"""Provider versions: half-open validity intervals, one open version each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.values import open_end
from tidewell.operators.clean import PROVIDER_ATTRIBUTES
from tidewell.operators.keys import assign_keys
from tidewell.operators.latest import first_by
from tidewell.operators.ordered import with_next, with_previous

NATURAL = "provider_id"
VERSION_COLUMNS = [
    "provider_key", NATURAL, *PROVIDER_ATTRIBUTES,
    "effective_start_at", "effective_end_at", "is_current", "attribute_hash", "created_at", "updated_at",
]


def _as_version(event: DataFrame, now: Column, end: Column, current: Column) -> DataFrame:
    return event.select(
        "provider_key", NATURAL, *PROVIDER_ATTRIBUTES,
        F.col("effective_at").alias("effective_start_at"),
        end.alias("effective_end_at"), current.alias("is_current"), "attribute_hash",
        now.alias("created_at"), now.alias("updated_at"),
    )


def earliest_states(changes: DataFrame) -> DataFrame:
    order = [F.col("effective_at").asc_nulls_last(), F.col("record_updated_at").asc_nulls_last(),
             F.col("attribute_hash").asc_nulls_last()]
    return first_by(changes, [NATURAL], order)


def latest_changes(changes: DataFrame) -> DataFrame:
    """Newest event per provider in a batch; further columns settle ties."""
    order = [F.col("record_updated_at").desc_nulls_last(), F.col("effective_at").desc_nulls_last(),
             F.col("attribute_hash").desc_nulls_last()]
    return first_by(changes, [NATURAL], order)


def scd2_seed(changes: DataFrame, target: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """Add the earliest state of every provider the target lacks, open and current."""
    moment = F.current_timestamp() if now is None else now
    first = earliest_states(changes)
    if target is not None:
        first = first.join(target.select(NATURAL), NATURAL, "left_anti")
    keyed = assign_keys(first.select(NATURAL, *PROVIDER_ATTRIBUTES, "effective_at", "attribute_hash"),
                        [NATURAL], "provider_key", existing=target)
    seeded = _as_version(keyed, moment, open_end(), F.lit(True))
    return seeded if target is None else target.unionByName(seeded)


def scd2_apply(dim: DataFrame, changes: DataFrame, now: Column | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Close changed versions and open their successors, in one pass.

    A changed hash with a later time closes the current version and opens a new
    one; an unknown provider opens its first. Same hash, or a time at or before
    the current start, changes nothing. Closed history takes no part in the join.
    Keys are set aside for the whole batch, so unused ones leave gaps. `dim` may be a part of a
    dimension that holds the changed providers; `existing` is then the whole, whose keys are taken.
    """
    moment = F.current_timestamp() if now is None else now
    delta = latest_changes(changes).select(NATURAL, *PROVIDER_ATTRIBUTES, "effective_at", "attribute_hash")
    keyed = assign_keys(delta, [NATURAL], "provider_key", existing=dim if existing is None else existing)
    incoming = _as_version(keyed, moment, open_end(), F.lit(True)).select(*VERSION_COLUMNS)

    current = dim.filter("is_current").select(*VERSION_COLUMNS)
    left = current.select(F.col(NATURAL).alias("_cid"), F.struct(*VERSION_COLUMNS).alias("c"))
    right = incoming.select(F.col(NATURAL).alias("_did"), F.struct(*VERSION_COLUMNS).alias("d"))
    pairs = left.join(right, F.col("_cid") == F.col("_did"), "full_outer")

    both = F.col("c").isNotNull() & F.col("d").isNotNull()
    changed = (both & (F.col("c.attribute_hash") != F.col("d.attribute_hash"))
               & (F.col("d.effective_start_at") > F.col("c.effective_start_at")))
    closed = (
        F.col("c").withField("effective_end_at", F.col("d.effective_start_at"))
        .withField("is_current", F.lit(False)).withField("updated_at", moment)
    )
    after = F.array_compact(F.array(
        F.when(changed, closed).otherwise(F.col("c")),
        F.when(changed | F.col("c").isNull(), F.col("d")),
    ))
    touched = pairs.select(F.explode(after).alias("v")).select("v.*")
    return dim.filter(~F.col("is_current")).select(*VERSION_COLUMNS).unionByName(touched)


def scd2_apply_all(dim: DataFrame, changes: DataFrame, now: Column | None = None, unit: str = "month",
                   existing: DataFrame | None = None) -> DataFrame:
    """Like `scd2_apply`, for any number of changes per provider in one batch.

    The current version takes part as the event that opened it; events at or
    before its start are late and stay out, as in the one-change form.
    """
    moment = F.current_timestamp() if now is None else now
    columns = [NATURAL, *PROVIDER_ATTRIBUTES, "effective_at", "attribute_hash"]
    current = dim.filter("is_current")
    starts = current.select(NATURAL, F.col("effective_start_at").alias("_start"))
    order = [F.col("record_updated_at").desc_nulls_last(), F.col("attribute_hash").desc_nulls_last()]
    later = first_by(changes, [NATURAL, "effective_at"], order).join(starts, NATURAL, "left").filter(
        F.col("_start").isNull() | (F.col("effective_at") > F.col("_start"))).select(*columns)
    affected = current.join(later.select(NATURAL).distinct(), NATURAL, "left_semi")
    opened = affected.withColumnRenamed("effective_start_at", "effective_at")
    events = later.unionByName(opened.select(*columns, "provider_key", "created_at", "updated_at"), allowMissingColumns=True)

    walked = with_previous(events, NATURAL, "effective_at", "attribute_hash", "_previous", unit)
    kept = walked.filter(F.col("_previous").isNull() | (F.col("_previous") != F.col("attribute_hash"))).drop("_previous")
    ended = with_next(kept, NATURAL, "effective_at", "effective_at", "_next", unit)
    fresh = assign_keys(ended.filter(F.col("provider_key").isNull()).drop("provider_key"),
                        [NATURAL, "effective_at"], "provider_key", existing=dim if existing is None else existing)
    end, is_open = F.coalesce("_next", open_end()), F.col("_next").isNull()
    added = _as_version(fresh, moment, end, is_open).select(*VERSION_COLUMNS)
    known = ended.filter(F.col("provider_key").isNotNull()).select(
        "provider_key", NATURAL, *PROVIDER_ATTRIBUTES, F.col("effective_at").alias("effective_start_at"),
        end.alias("effective_end_at"), is_open.alias("is_current"), "attribute_hash", "created_at",
        F.when(is_open, F.col("updated_at")).otherwise(moment).alias("updated_at"))
    untouched = dim.filter("is_current").join(later.select(NATURAL).distinct(), NATURAL, "left_anti")
    parts = [dim.filter(~F.col("is_current")), untouched, known, added]
    return reduce(DataFrame.unionByName, [p.select(*VERSION_COLUMNS) for p in parts])


def scd2_history(changes: DataFrame, now: Column | None = None, unit: str = "month") -> DataFrame:
    """Full version history from all events of a provider, any number per batch.

    Of several events at one instant the newest record counts. Events that repeat
    the hash before them open no version.
    """
    moment = F.current_timestamp() if now is None else now
    order = [F.col("record_updated_at").desc_nulls_last(), F.col("attribute_hash").desc_nulls_last()]
    states = first_by(changes, [NATURAL, "effective_at"], order).select(
        NATURAL, *PROVIDER_ATTRIBUTES, "effective_at", "attribute_hash")
    walked = with_previous(states, NATURAL, "effective_at", "attribute_hash", "_previous", unit)
    versions = walked.filter(F.col("_previous").isNull() | (F.col("_previous") != F.col("attribute_hash"))).drop("_previous")
    ended = with_next(versions, NATURAL, "effective_at", "effective_at", "_next", unit)
    keyed = assign_keys(ended, [NATURAL, "effective_at"], "provider_key")
    return _as_version(keyed, moment, F.coalesce("_next", open_end()), F.col("_next").isNull())
