"""Fixed values that results depend on."""

# Historical team name -> canonical team name.
TEAM_ALIASES = {
    "Delhi Daredevils": "Delhi Capitals",
    "Kings XI Punjab": "Punjab Kings",
    "Rising Pune Supergiant": "Rising Pune Supergiants",
    "Royal Challengers Bangalore": "Royal Challengers Bengaluru",
}

# Order of the process stages.
STAGE_SEQUENCE = ["bronze", "staging", "validation", "cdc", "silver", "gold", "lakehouse"]

# Service-level limit per activity, in seconds.
SLA_SECONDS = {
    "bronze": 30.0,
    "source_ingestion": 30.0,
    "produce": 20.0,
    "kafka_producer": 20.0,
    "consume": 20.0,
    "kafka_consumer": 20.0,
    "staging": 25.0,
    "validation": 15.0,
    "cdc": 15.0,
    "silver": 30.0,
    "silver_load": 30.0,
    "gold": 25.0,
    "gold_load": 25.0,
    "lakehouse": 20.0,
    "lakehouse_sync": 20.0,
    "lakehouse_streaming_ingest": 20.0,
    "lakehouse_health_check": 10.0,
    "lakehouse_compaction": 30.0,
    "lakehouse_snapshot_expiry": 15.0,
    "lakehouse_orphan_cleanup": 15.0,
    "lakehouse_maintenance_audit": 10.0,
    "quarantine": 10.0,
    "total_pipeline": 180.0,
}
SLA_FALLBACK_ACTIVITY = "silver"
SLA_DEFAULT_SECONDS = 30.0

# The shorter limit list of the per-event SLA report.
SLA_REPORT_SECONDS = {
    "bronze": 30.0,
    "source_ingestion": 30.0,
    "staging": 25.0,
    "validation": 15.0,
    "cdc": 15.0,
    "silver": 30.0,
    "silver_load": 30.0,
    "gold": 25.0,
    "gold_load": 25.0,
    "quarantine": 10.0,
}

# Activities allowed directly after each activity.
ALLOWED_TRANSITIONS = {
    "init": ["bronze", "source_ingestion", "staging", "lakehouse_health_check"],
    "bronze": ["staging", "kafka_producer", "validation"],
    "source_ingestion": ["kafka_producer", "staging"],
    "kafka_producer": ["kafka_consumer", "staging"],
    "kafka_consumer": ["staging", "validation"],
    "staging": ["validation", "cdc"],
    "validation": ["cdc", "quarantine", "silver", "silver_load"],
    "quarantine": ["done", "end", "cdc", "silver", "silver_load"],
    "cdc": ["silver", "silver_load"],
    "silver": ["gold", "gold_load", "done"],
    "silver_load": ["gold", "gold_load", "done"],
    "gold": ["done", "end", "serving", "bronze", "staging", "source_ingestion", "lakehouse", "lakehouse_sync"],
    "gold_load": ["done", "end", "serving", "bronze", "staging", "source_ingestion", "lakehouse", "lakehouse_sync"],
    "lakehouse": ["done", "end", "serving", "bronze", "staging", "source_ingestion"],
    "lakehouse_sync": ["done", "end", "serving", "bronze", "staging", "source_ingestion"],
    "lakehouse_health_check": ["lakehouse_compaction", "done", "end"],
    "lakehouse_compaction": ["lakehouse_snapshot_expiry", "done", "end"],
    "lakehouse_snapshot_expiry": ["lakehouse_orphan_cleanup", "done", "end"],
    "lakehouse_orphan_cleanup": ["lakehouse_maintenance_audit", "done", "end"],
    "lakehouse_maintenance_audit": ["done", "end"],
}

# Transitions that stay legal whatever transition table is passed in.
ALWAYS_LEGAL_TRANSITIONS = {
    "validation": ["quarantine"],
    "gold": ["bronze", "staging", "source_ingestion"],
    "gold_load": ["bronze", "staging", "source_ingestion"],
}

# Activities whose repetition counts as a legitimate retry.
RETRY_ACTIVITIES = [
    "bronze", "source_ingestion", "produce", "consume", "staging", "validation", "cdc",
    "silver", "silver_load", "gold", "gold_load", "lakehouse", "lakehouse_sync",
    "lakehouse_streaming_ingest", "lakehouse_health_check", "lakehouse_compaction",
    "lakehouse_snapshot_expiry", "lakehouse_orphan_cleanup", "lakehouse_maintenance_audit",
]

# Statuses that end an activity.
TERMINAL_STATUSES = ["SUCCESS", "FAILED", "COMPLETED", "QUARANTINED"]

# Dismissals not credited to the bowler in the raw-document report.
UNCREDITED_DISMISSALS = ["run out", "retired hurt"]

# Limits used by the data-quality rules.
DEFAULT_OVERS = 20
DEFAULT_BALLS_PER_OVER = 6
MAX_RUNS_PER_BALL = 7
MAX_MATCH_RUNS = 560
MIN_COMPLETED_RUNS = 30
SQUAD_SIZE = (11, 16)
OVERS_RANGE = (5, 20)
EXTREME_LATENCY_SECONDS = 45
