"""The season load: staged documents -> checked -> changes -> silver -> gold -> lakehouse, published
together. One run handles any number of seasons in the same jobs; nothing loops over documents."""

from __future__ import annotations

import json
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators import cdc, gold, quality, silver
from matchlake.plans.publish import SHARED, Store
from matchlake.schemas import PROCESS_EVENT
from matchlake.sources import documents

INCREMENTAL, REPROCESS = "INCREMENTAL", "REPROCESS"


@dataclass
class Outcome:
    version: str
    mode: str
    seasons: list[str]
    counts: dict[str, int] = field(default_factory=dict)


#: Documents that cannot be read, or name no season, are kept under this entry.
UNROUTED = "unrouted"


def judge(staged: DataFrame, by_season: bool = False) -> DataFrame:
    """One document a match, parsed, hashed and judged. What names no season fails like any other fault.
    ``by_season`` brings the texts of a season together first."""
    order = [c for c in ("arrived",) if c in staged.columns]
    single = documents.one_per_match(staged.select("match_id", "raw_data", *order)).drop(*order)
    parsed = documents.parse((documents.gathered(single) if by_season else single).withColumn("record_hash", F.sha2("raw_data", 256)))
    unrouted = F.col("season").isNull()
    return quality.classify(parsed).withColumns({
        "error_message": F.when(unrouted & F.col("error_type").isNull(), "no season").otherwise(F.col("error_message")),
        "error_type": F.when(unrouted, F.coalesce("error_type", F.lit("REQUIRED_FIELDS"))).otherwise(F.col("error_type")),
    })


def check_documents(store: Store, staged: DataFrame, version: str, seasons: list[str] | None) -> DataFrame:
    """Parse, judge, route and hash the documents once, and keep the result as a table.

    Judging comes before routing, so a document that cannot be read is not lost on the way: it has no
    season and is kept under ``UNROUTED``. Everything after reads that table column by column; no
    document is parsed a second time.
    """
    judged = judge(staged, by_season=True).withColumn("season", F.coalesce("season", F.lit(UNROUTED)))
    if seasons:
        judged = judged.where(F.col("season").isin([*map(str, seasons), UNROUTED]))
    store.write("checked", judged, version, rebalance=False)
    return store.read_version("checked", version)


def _detect(store: Store, checked: DataFrame, mode: str, seasons: list[str] | None, complete: bool, version: str) -> DataFrame:
    """The run's changes, written to the change log. A snapshot speaks for the seasons asked for, or
    else for those that occur in it."""
    current = store.current()
    valid = quality.valid(checked)
    staged = valid.select(F.col("match_id").alias("business_key"), "record_hash")
    present = checked.where("error_type IS NOT NULL").select(F.col("match_id").alias("business_key"))
    state = store.require("cdc_state", {k: v for k, v in current.items() if k == SHARED})
    loaded = store.require("match", {k: v for k, v in current.items() if k != SHARED})
    empty_state = store.spark.createDataFrame([], "business_key string, record_hash string")
    state = empty_state if state is None else state.select("business_key", "record_hash")
    if loaded is None:
        loaded = empty_state.select("business_key")
    else:
        spoken_for = [str(s) for s in seasons] if seasons else [r["season"] for r in checked.select("season").distinct().collect()]
        loaded = loaded.select(F.col("match_id").alias("business_key"), F.col("season").isin(spoken_for).alias("in_scope"))
    changes = cdc.classify(staged, state, loaded, complete and mode == INCREMENTAL, present)
    if mode == REPROCESS:
        # every staged document is loaded again, whatever its hash says
        again = F.when(F.col("operation") == cdc.SKIP, cdc.UPDATE).otherwise(F.col("operation"))
        changes = changes.withColumn("operation", again)
    store.append_log("cdc_log", cdc.change_log(changes, version), version)
    return store.read_log("cdc_log", version)


class StageLog:
    """What each stage of a run did and when, as process events; added to the log when the run ends,
    also when a stage fails."""

    def __init__(self, store: Store, version: str):
        self.store, self.version, self.rows = store, version, []
        self.seasons: list[str] = []

    @contextmanager
    def stage(self, activity: str):
        """Time a stage; the caller puts what it handled into the yielded dict as ``records``."""
        began, told, status, message = datetime.now(timezone.utc), {}, "SUCCESS", None
        try:
            yield told
        except BaseException as error:
            status, message = "FAILED", f"{type(error).__name__}: {error}"[:1000]
            raise
        finally:
            ended = datetime.now(timezone.utc)
            self.rows.append((
                len(self.rows) + 1, self.version, activity, began, ended, (ended - began).total_seconds(), status,
                told.get("records"), message,
            ))
            if status == "FAILED":
                self.close()

    def close(self) -> None:
        # a second attempt of a run keeps the events of the first
        attempt = f"{self.version}-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
        schema = PROCESS_EVENT.replace("records_processed int", "records_processed bigint")
        # the seasons are known after the first stages and hold for all
        metadata = json.dumps({"season": ",".join(self.seasons)}) if self.seasons else None
        rows = self.store.spark.createDataFrame([(*row, metadata) for row in self.rows], schema)
        self.store.append_log("process_events", rows.coalesce(1), attempt)


def load(
    store: Store,
    staged: DataFrame | None,
    version: str,
    seasons: list[str] | None = None,
    mode: str = INCREMENTAL,
    complete: bool = False,
    resume: bool = False,
) -> Outcome:
    """Load staged documents (match_id, raw_data, on request arrived) and publish the result in one step.

    INCREMENTAL touches changed matches only; an unchanged snapshot publishes nothing. REPROCESS
    loads all staged matches again and rebuilds the dimensions. ``complete`` says that the documents
    are all there are of their seasons, so matches of these that are missing were withdrawn; a match
    whose document is there but fails a rule keeps its last good version. ``resume`` starts from the
    documents an earlier attempt of the same version has already checked.

    Quarantined documents, changes and the events of the run's stages go to logs over all runs
    (``store.read_log``), whether or not the run publishes anything.
    """
    if mode not in (INCREMENTAL, REPROCESS):
        raise ValueError(f"unknown mode {mode}")
    log, parent = StageLog(store, version), store.head()
    with log.stage("validation") as told:
        checked = store.read_version("checked", version) if resume else check_documents(store, staged, version, seasons)
        store.append_log("quarantine_records", quality.quarantine(checked), version)
        failed, told["records"] = checked.agg(F.count("error_type"), F.count("*")).first()
    with log.stage("cdc") as told:
        changes = _detect(store, checked, mode, seasons, complete, version)
        counts = cdc.counts(changes).first().asDict() | {"failed": failed}
        told["records"] = counts["read"]

    valid = quality.valid(checked)
    current = store.current()
    touched = cdc.keys_of(changes, [cdc.INSERT, cdc.UPDATE, cdc.DELETE])
    stored_match = store.require("match", {k: v for k, v in current.items() if k != SHARED})
    affected = valid.join(touched, "match_id", "left_semi").select("season")
    if stored_match is not None:
        affected = affected.unionByName(stored_match.join(touched, "match_id", "left_semi").select("season"))
    affected_seasons = sorted(row["season"] for row in affected.distinct().collect())
    outcome = Outcome(version, mode, affected_seasons, counts)
    log.seasons = affected_seasons
    if affected_seasons:
        with log.stage("silver") as told:
            changed = _load_silver(store, valid, changes, counts, current, affected_seasons, version)
            told["records"] = counts["inserted"] + counts["updated"] + counts["deleted"]
        with log.stage("gold") as told:
            tables = _load_gold(store, touched, changes, current, affected_seasons, mode, version)
            told["records"] = counts["inserted"] + counts["updated"] + counts["deleted"]
        with log.stage("lakehouse") as told:
            lake = silver.flat_record(changed)
            stored_lake = store.require("lakehouse", {s: current[s] for s in affected_seasons if s in current})
            if stored_lake is not None:
                lake = stored_lake.join(touched, "match_id", "left_anti").unionByName(lake)
            store.write_all({**tables, "lakehouse": lake}, version, together=("lakehouse",))
            store.commit(version, [*affected_seasons, SHARED], parent=parent)
            told["records"] = counts["inserted"] + counts["updated"]
    log.close()
    return _recorded(store, outcome)


def _load_silver(
    store: Store, valid: DataFrame, changes: DataFrame, counts: dict, current: dict, affected: list[str], version: str
) -> DataFrame:
    """Rewrite the silver tables of the affected seasons; all others stay where they are. Gives the
    documents that were new or changed."""
    before = {s: current[s] for s in affected if s in current}
    changed = valid
    if counts["skipped"]:
        # ten tables and the lakehouse rows are made from these documents: pick them out once
        store.write("changed", valid.join(cdc.keys_of(changes, [cdc.INSERT, cdc.UPDATE]), "match_id", "left_semi"), version)
        changed = store.read_version("changed", version)
    fresh = silver.flatten(changed)
    tables = {}
    for table in silver.MATCH_TABLES:
        stored = store.require(table, before)
        rows = fresh[table]
        if stored is not None:
            # a wicket's fielders and the like are removed with their match
            rows = stored.join(cdc.keys_of(changes, [cdc.UPDATE, cdc.DELETE]), "match_id", "left_anti").unionByName(rows)
        tables[table] = rows
    shared = {SHARED: current[SHARED]} if SHARED in current else {}
    store.write_all({**tables, **_entities(store, fresh, shared)}, version, together=tuple(tables))
    return changed


def _load_gold(
    store: Store, touched: DataFrame, changes: DataFrame, current: dict, affected: list[str], mode: str, version: str
) -> dict[str, DataFrame]:
    """Facts of changed matches and totals of affected seasons are written; the dimensions from all
    totals and the remembered hashes, which become visible with what they describe, are given back."""
    before = {s: current[s] for s in affected if s in current}
    shared = {SHARED: current[SHARED]} if SHARED in current else {}
    by_season = {k: v for k, v in current.items() if k != SHARED} | {s: version for s in affected}
    of_run = {s: version for s in affected}
    matches, deliveries, wickets = [store.read(t, of_run) for t in ("match", "delivery", "wicket")]
    stored_fact = store.require("fact_match_summary", before)
    if stored_fact is None:
        fact = gold.match_summary(matches, deliveries, wickets)
    else:
        recomputed = gold.match_summary_for(touched, matches, deliveries, wickets)
        fact = gold.refresh_fact(stored_fact, touched, recomputed)
    totals = {
        "team_season": gold.team_totals(matches, deliveries, ["season"]),
        "player_season": gold.player_totals(deliveries, wickets, ["season"]),
    }
    store.write_all({"fact_match_summary": fact, **totals}, version)
    tables = _dimensions(store, by_season, shared, mode, version)
    state = store.require("cdc_state", shared)
    empty = store.spark.createDataFrame([], "business_key string, record_hash string")
    tables["cdc_state"] = cdc.state_after(empty if state is None else state, changes)
    return tables


def _recorded(store: Store, outcome: Outcome) -> Outcome:
    store.record_run({**vars(outcome), "status": "SUCCESS"})
    return outcome


def _entities(store: Store, fresh: dict[str, DataFrame], shared: dict[str, str]) -> dict[str, DataFrame]:
    """Teams, officials and players: what was known and what the run brings."""
    tables = {}
    for table, columns in {"team": ["team_name"], "official": ["official_name", "official_role"]}.items():
        stored = store.read(table, shared) if shared else None
        rows = fresh[table].select(*columns)
        tables[table] = rows if stored is None else rows.unionByName(stored.select(*columns)).distinct()
    players = fresh["player"]
    stored = store.read("player", shared) if shared else None
    if stored is not None:
        # a newly stated identifier replaces the stored one, a missing one does not
        both = players.withColumn("is_new", F.lit(1)).unionByName(
            stored.select("player_name", "registry_id").withColumn("is_new", F.lit(0))
        )
        stated = F.when(F.col("registry_id").isNotNull(), F.struct("is_new", "registry_id"))
        players = both.groupBy("player_name").agg(F.max(stated).alias("last")).select("player_name", "last.registry_id")
    tables["player"] = players
    return tables


def _dimensions(
    store: Store, by_season: dict[str, str], shared: dict[str, str], mode: str, version: str
) -> dict[str, DataFrame]:
    """Dimensions over all seasons as they will be published; INCREMENTAL keeps vanished entities."""
    entities = {SHARED: version}
    totals = {name: store.read(name, by_season) for name in ("team_season", "player_season")}
    dimensions = {
        "dim_team": ("team_name", gold.team_dimension_from(store.read("team", entities), totals["team_season"])),
        "dim_player": ("player_name", gold.player_dimension_from(store.read("player", entities), totals["player_season"])),
    }
    tables = {}
    for table, (key, rows) in dimensions.items():
        stored = store.read(table, shared) if shared and mode == INCREMENTAL else None
        tables[table] = rows if stored is None else gold.upsert(stored.drop("season"), rows, key)
    return tables


def backfill(store: Store, staged: DataFrame, version: str, first: int, last: int, mode: str = REPROCESS) -> Outcome:
    """Load a range of seasons in one run."""
    return load(store, staged, version, [str(s) for s in range(first, last + 1)], mode)


def delete_season(store: Store, season: str, run_id: str) -> int:
    """Withdraw a season; how many matches it held.

    Its hashes are forgotten and the dimensions rebuilt from the totals of the other seasons, in the
    same commit; the season's data goes when its version expires.
    """
    current, parent = store.current(), store.head()
    if season not in current:
        return 0
    gone = store.require("match", {season: current[season]}).select(F.col("match_id").alias("business_key"))
    held = gone.count()
    if SHARED in current:
        shared = {SHARED: current[SHARED]}
        kept = {t: store.require(t, shared).drop("season") for t in ("team", "official", "player")}
        store.write_all(kept, run_id)
        by_season = {k: v for k, v in current.items() if k not in (SHARED, season)}
        tables = _dimensions(store, by_season, shared, REPROCESS, run_id)
        tables["cdc_state"] = store.require("cdc_state", shared).select("business_key", "record_hash").join(gone, "business_key", "left_anti")
        store.write_all(tables, run_id)
        store.commit(run_id, [SHARED], [season], parent)
    else:
        store.commit(run_id, [], [season], parent)
    return held


STATUS_STAGES = ["bronze", "staging", "validation", "cdc", "silver", "gold"]


def stage_status(log: DataFrame) -> DataFrame:
    """The newest status per season and stage, one row per season, with the newest status overall.

    ``log``: season, stage, status, at, seq (a tie-break).
    """
    order = F.struct("at", "seq")
    newest = [
        F.max_by("status", F.when(F.col("stage") == stage, order)).alias(f"{stage}_status") for stage in STATUS_STAGES
    ]
    return log.groupBy("season").agg(
        *newest, F.max_by("status", order).alias("status"), F.max("at").alias("last_processed_at")
    )


def stage_events(store: Store) -> DataFrame:
    """(season, stage, status, at, seq) of all runs, one row per season that a run touched, as
    ``stage_status`` takes them; a run that touched none counts under the shared entry."""
    events = store.read_log("process_events")
    seasons = F.coalesce(F.get_json_object("metadata", "$.season"), F.lit(SHARED))
    return events.select(
        F.explode(F.split(seasons, ",")).alias("season"), F.col("activity").alias("stage"), "status",
        F.col("event_timestamp").alias("at"), F.col("event_id").alias("seq"),
    )
