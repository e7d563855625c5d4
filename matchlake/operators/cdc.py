"""Change detection by content hash, and applying the changes to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTITY = "match"
INSERT, UPDATE, SKIP, DELETE = "INSERT", "UPDATE", "SKIP", "DELETE"
OPERATIONS = [INSERT, UPDATE, SKIP, DELETE]


def fingerprints(df: DataFrame, key: str, content: str, *also: str) -> DataFrame:
    """(key, record_hash, ...): the SHA-256 of each record's text."""
    return df.select(F.col(key).alias("business_key"), F.sha2(content, 256).alias("record_hash"), *also)


def classify(
    staged: DataFrame, state: DataFrame, loaded: DataFrame, complete: bool = False, present: DataFrame | None = None
) -> DataFrame:
    """(business_key, operation, old_hash, new_hash) of every staged key and every vanished one.

    ``staged`` and ``state`` carry business_key and record_hash, ``loaded`` the business_key of
    records now in the target. A remembered key that is not loaded (any more) is an INSERT, whatever
    its hash. Only a ``complete`` snapshot can tell that a record is gone; with a part of one nothing
    is deleted. ``loaded`` may say in ``in_scope`` which records the snapshot speaks for, and
    ``present`` lists keys that were delivered but cannot be loaded: those are not gone.

    The inputs are tagged, unioned and aggregated once, instead of joined: one shuffle of narrow
    rows, and repeated copies of a key are combined before it.
    """
    nothing, no, yes = F.lit(None).cast("string"), F.lit(False), F.lit(True)
    scope = F.col("in_scope") if "in_scope" in loaded.columns else yes
    tagged = (
        staged.select(
            "business_key", F.col("record_hash").alias("new_hash"), nothing.alias("old_hash"),
            no.alias("is_loaded"), no.alias("in_scope"), yes.alias("is_present"),
        )
        .unionAll(state.select("business_key", nothing, F.col("record_hash"), no, no, no))
        .unionAll(loaded.select("business_key", nothing, nothing, yes, scope, no))
    )
    if present is not None:
        tagged = tagged.unionAll(present.select("business_key", nothing, nothing, no, no, yes))
    merged = tagged.groupBy("business_key").agg(
        F.max("new_hash").alias("new_hash"), F.max("old_hash").alias("old_hash"),
        *[F.max(flag).alias(flag) for flag in ("is_loaded", "in_scope", "is_present")],
    )
    new, old = F.col("new_hash"), F.col("old_hash")
    operation = (
        F.when(new.isNotNull() & (old.isNull() | ~F.col("is_loaded")), INSERT)
        .when(new.isNotNull() & (new != old), UPDATE)
        .when(new.isNotNull(), SKIP)
        .when(F.col("in_scope") & ~F.col("is_present") & F.lit(complete), DELETE)
    )
    return merged.select("business_key", operation.alias("operation"), "old_hash", "new_hash").where(
        F.col("operation").isNotNull()
    )


def change_log(changes: DataFrame, run_id: str, entity: str = ENTITY) -> DataFrame:
    return changes.select(
        F.lit(run_id).alias("run_id"), F.lit(entity).alias("entity_name"), "business_key", "operation",
        "old_hash", "new_hash",
    )


def state_after(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored hashes once the changes are loaded. To be written after the load, not before."""
    touched = changes.where(F.col("operation") != SKIP)
    kept = state.select("business_key", "record_hash").join(touched, "business_key", "left_anti")
    fresh = touched.where(F.col("operation") != DELETE).select("business_key", F.col("new_hash").alias("record_hash"))
    return kept.unionByName(fresh)


def counts(changes: DataFrame) -> DataFrame:
    """How many records were read, inserted, updated, deleted and skipped: one row."""
    how_many = lambda op: F.count(F.when(F.col("operation") == op, 1))
    return changes.agg(
        F.count("new_hash").alias("read"),
        how_many(INSERT).alias("inserted"),
        how_many(UPDATE).alias("updated"),
        how_many(DELETE).alias("deleted"),
        how_many(SKIP).alias("skipped"),
    )


def keys_of(changes: DataFrame, operations: list[str], name: str = "match_id") -> DataFrame:
    return changes.where(F.col("operation").isin(operations)).select(F.col("business_key").alias(name))


def apply_changes(current: DataFrame, fresh: DataFrame, changes: DataFrame, key: str = "match_id") -> DataFrame:
    """Rows of updated and deleted records out, rows of inserted and updated records in."""
    kept = current.join(keys_of(changes, [UPDATE, DELETE], key), key, "left_anti")
    added = fresh.join(keys_of(changes, [INSERT, UPDATE], key), key, "left_semi")
    return kept.unionByName(added)
