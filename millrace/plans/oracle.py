"""SQL for DuckDB that gives the rows of the registered queries, over the same derived tables."""

from __future__ import annotations

from ..operators.orphans import ABANDONED
from ..operators.reports import CATALOGUE
from ..sources.derived import NOW, ORPHAN_SECONDS

_NOW = f"TIMESTAMP '{NOW}'"

JOBS = """
SELECT props AS job, lpad(CAST(event_id AS VARCHAR), 26, '0') AS id, event_type AS job_type,
       CASE WHEN event_id % 20 < 6 THEN 'Pending' WHEN event_id % 20 < 8 THEN 'Queued' WHEN event_id % 20 < 10 THEN 'Running'
            WHEN event_id % 20 < 15 THEN 'Done' WHEN event_id % 20 < 18 THEN 'Failed' ELSE 'Killed' END AS status,
       CAST(CASE WHEN event_id % 20 < 6 THEN 0 WHEN event_id % 20 >= 17 THEN 1 + event_id % 7
                 ELSE (event_id % 11) % (1 + event_id % 7) END AS INT) AS attempts,
       CAST(1 + event_id % 7 AS INT) AS max_attempts, CAST(ts AS TIMESTAMP) AS run_at,
       CASE WHEN event_id % 20 BETWEEN 10 AND 14 THEN concat('{"Ok":', CAST(event_id AS VARCHAR), '}')
            WHEN event_id % 20 >= 15 THEN '{"Err":"boom"}' END AS last_result,
       CASE WHEN event_id % 20 >= 6 THEN CAST(date_trunc('second', ts) AS TIMESTAMP) END AS lock_at,
       CASE WHEN event_id % 20 >= 6 THEN concat('w-', CAST(user_id % 8 AS VARCHAR)) END AS lock_by,
       CASE WHEN event_id % 20 >= 10 THEN ts + CAST(floor(value * 60) AS BIGINT) * INTERVAL '1' SECOND END AS done_at,
       CAST(user_id % 4 AS INT) AS priority, props AS metadata,
       CASE WHEN event_id % 3 = 0 THEN concat('k-', CAST(event_id AS VARCHAR)) END AS idempotency_key
FROM events"""

WORKERS = f"""
SELECT DISTINCT concat('w-', CAST(user_id % 8 AS VARCHAR)) AS id, event_type AS worker_type, 'ParquetStore' AS storage_name,
       '' AS layers, {_NOW} - (user_id % 8) * INTERVAL '37' SECOND AS last_seen, {_NOW} - INTERVAL '30' DAY AS started_at,
       CASE WHEN user_id % 8 <> 7 THEN concat('t-', CAST(user_id % 8 AS VARCHAR)) END AS lease_token
FROM events
UNION ALL SELECT 'w-idle', 'idle-queue', 'ParquetStore', '', {_NOW}, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR)"""

BATCH = """
SELECT lpad(concat('n', CAST(event_id AS VARCHAR)), 26, '0') AS id, event_type AS job_type, CAST(1 + event_id % 7 AS INT) AS max_attempts,
       CAST(ts AS TIMESTAMP) AS run_at, CAST(user_id % 4 AS INT) AS priority,
       CASE WHEN event_id % 4 = 0 THEN concat('k-', CAST(event_id AS VARCHAR))
            WHEN event_id % 4 = 1 THEN concat('b-', CAST(event_id % 90 AS VARCHAR)) END AS idempotency_key
FROM events"""

ACKS = """
SELECT id AS task_id, job_type AS queue, lock_by AS worker_id,
       CASE WHEN attempts % 3 = 2 THEN lock_at - INTERVAL '1' SECOND ELSE lock_at END AS lock_at,
       CAST(CASE WHEN priority = 3 THEN attempts + 1 ELSE attempts END AS INT) AS started_attempts, max_attempts > 3 AS ok,
       CASE WHEN lock_by = 'w-5' THEN 'wrong' WHEN lock_by = 'w-6' THEN NULL ELSE concat('t-', right(lock_by, 1)) END AS lease_token
FROM jobs WHERE status = 'Running'"""

ACKS_AGAIN = """
SELECT task_id, queue, worker_id, lock_at - INTERVAL '1 hour' AS lock_at, started_attempts, ok, lease_token FROM acks
UNION ALL SELECT task_id, queue, worker_id, lock_at, started_attempts, ok, lease_token FROM acks
UNION ALL SELECT task_id, queue, worker_id, lock_at, started_attempts, NOT ok, lease_token FROM acks WHERE started_attempts % 2 = 0"""

REQUESTS = """
SELECT id, worker_type, 'Other' AS storage_name, 'L' AS layers, lease_token
FROM (VALUES ('w-new', 'click', 't-n'), ('w-1', 'click', 't-1'), ('w-7', 'click', 't-x'), ('w-6', 'view', 't-y'), ('w-0', 'view', 't-z')) v(id, worker_type, lease_token)"""

BROKEN = """
SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 89 = 1 THEN 'Lost' ELSE status END AS status,
                  CASE WHEN CAST(id AS BIGINT) % 83 = 2 THEN -1 WHEN CAST(id AS BIGINT) % 79 = 3 THEN max_attempts + 1 ELSE attempts END AS attempts,
                  CASE WHEN CAST(id AS BIGINT) % 73 = 4 THEN 0 ELSE max_attempts END AS max_attempts,
                  CASE WHEN CAST(id AS BIGINT) % 97 = 0 THEN -1 ELSE priority END AS priority,
                  CASE WHEN lock_by = 'w-4' THEN 'w-x' ELSE lock_by END AS lock_by,
                  CASE WHEN CAST(id AS BIGINT) % 50 = 0 THEN 'same' ELSE idempotency_key END AS idempotency_key) FROM jobs"""

_PARTS = {"jobs": JOBS, "workers": WORKERS, "batch": BATCH, "acks": ACKS, "acks_again": ACKS_AGAIN, "requests": REQUESTS, "broken": BROKEN}
_NEEDS = {"acks": ("jobs",), "acks_again": ("jobs", "acks"), "broken": ("jobs",)}
_COLUMNS = "id, job_type, status, attempts, max_attempts, run_at, last_result, lock_at, lock_by, done_at, priority, idempotency_key"
_CLAIMABLE = "(status = 'Pending' OR (status = 'Failed' AND attempts < max_attempts))"
_TERMINAL = "(status IN ('Done', 'Killed') OR (status = 'Failed' AND attempts >= max_attempts))"
_DUE = f"run_at <= {_NOW}"
_IDS = "SELECT id FROM jobs UNION ALL SELECT concat('x', substring(id, 2, 25)) FROM jobs"
_STALE = f"last_seen <= {_NOW} - {ORPHAN_SECONDS} * INTERVAL '1' SECOND"


def _with(parts: str, body: str) -> str:
    """``body`` over the named derived tables."""
    names: list[str] = []
    for p in parts.split():
        for x in (*_NEEDS.get(p, ()), p):
            if x not in names:
                names.append(x)
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n]})" for n in names) + "\n" + body


def _taken(status: str, done: str) -> str:
    return f"id, job_type, '{status}' AS status, attempts, max_attempts, run_at, last_result, {_NOW} AS lock_at, 'w-new' AS lock_by, {done} AS done_at, priority, idempotency_key"


_NO_TIME = "CAST(NULL AS TIMESTAMP)"
_TOP = "ORDER BY priority DESC, run_at, id LIMIT"
_RANKED = f"SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY priority DESC, run_at, id) AS place FROM jobs WHERE {_CLAIMABLE} AND {_DUE}"
_MINUTES = "(epoch_us({b}) - epoch_us({a})) / 6e7"
_ENDED = "status IN ('Done', 'Failed', 'Killed')"
_HOUR, _DAY, _WEEK = (f"run_at >= {_NOW} - INTERVAL '{n}'" for n in ("1 hour", "1 day", "7 days"))
_TODAY = f"CAST(run_at AS DATE) = CAST({_NOW} AS DATE)"


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_STATS = {
    "RUNNING_JOBS": _n("status = 'Running'"),
    "PENDING_JOBS": _n("status = 'Pending'"),
    "FAILED_JOBS": _n("status = 'Failed'"),
    "ACTIVE_JOBS": _n("status IN ('Pending', 'Queued', 'Running')"),
    "STALE_RUNNING_JOBS": _n(f"status = 'Running' AND NOT {_HOUR}"),
    "KILL_RATE": f"round(100.0 * {_n("status = 'Killed'")} / nullif(CAST(count(*) AS DOUBLE), 0), 2)",
    "JOBS_PAST_HOUR": _n(_HOUR),
    "JOBS_TODAY": _n(_TODAY),
    "KILLED_JOBS_TODAY": _n(f"status = 'Killed' AND {_TODAY}"),
    "AVG_JOBS_PER_MINUTE_PAST_HOUR": f"round(CAST({_n(_HOUR)} AS DOUBLE) / 60.0, 2)",
    "TOTAL_JOBS": "count(*)",
    "DONE_JOBS": _n("status = 'Done'"),
    "COMPLETED_JOBS": _n(_ENDED),
    "KILLED_JOBS": _n("status = 'Killed'"),
    "SUCCESS_RATE": f"round(100.0 * {_n("status = 'Done'")} / nullif(CAST(count(*) AS DOUBLE), 0), 2)",
    "AVG_JOB_DURATION_MINS": f"round(avg({_MINUTES.format(a='run_at', b='done_at')}) FILTER (WHERE {_ENDED} AND done_at IS NOT NULL), 2)",
    "LONGEST_RUNNING_JOB_MINS": f"round(coalesce(max({_MINUTES.format(a='run_at', b=_NOW)}) FILTER (WHERE status = 'Running'), 0.0), 2)",
    "QUEUE_BACKLOG": _n(f"status = 'Pending' AND {_DUE}"),
    "JOBS_PAST_24_HOURS": _n(_DAY),
    "JOBS_PAST_7_DAYS": _n(_WEEK),
    "KILLED_JOBS_PAST_7_DAYS": _n(f"status = 'Killed' AND {_WEEK}"),
    "SUCCESS_RATE_PAST_24H": f"round(100.0 * {_n(f"status = 'Done' AND {_DAY}")} / nullif(CAST({_n(_DAY)} AS DOUBLE), 0), 2)",
    "AVG_JOBS_PER_HOUR_PAST_24H": f"round(CAST({_n(_DAY)} AS DOUBLE) / 24.0, 2)",
    "AVG_JOBS_PER_DAY_PAST_7D": f"round(CAST({_n(_WEEK)} AS DOUBLE) / 7.0, 2)",
    "MOST_RECENT_JOB": "max(run_at)",
    "OLDEST_PENDING_JOB": f"min(run_at) FILTER (WHERE status = 'Pending' AND {_DUE})",
}


def _metrics(where: str) -> str:
    """The metrics report: one aggregation, then a row for each statistic."""
    wide = ", ".join(f"{sql} AS {t}" for t, sql in _STATS.items())
    peak = f"(SELECT coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM jobs WHERE {where} GROUP BY extract(hour FROM run_at)))"
    value = lambda t, kind: f"epoch_us({t}) / 1e6" if kind == "Timestamp" else t
    rows = ", ".join(f"('{t}', '{kind}', coalesce(CAST({value(t, kind)} AS DOUBLE), 0.0), {p})" for t, kind, _, p in CATALOGUE if not t.startswith("DB_"))
    return _with("jobs", f"SELECT title, stat_type, value, CAST(priority AS INT) AS priority FROM (SELECT {wide}, {peak} AS PEAK_HOUR_JOBS FROM jobs WHERE {where}) w, LATERAL (VALUES {rows}) v(title, stat_type, value, priority)")


def _metrics_report() -> str:
    storage = " ".join(f"UNION ALL SELECT '{t}', '{kind}', CAST({p} AS INT), 'positive', CAST(NULL AS DOUBLE)" for t, kind, _, p in CATALOGUE if t.startswith("DB_"))
    return f"SELECT title, stat_type, priority, CASE WHEN stat_type = 'Number' THEN CAST(CAST(value AS BIGINT) AS VARCHAR) END AS text, value AS number FROM ({_metrics('TRUE')}) {storage}"


_QUEUE_STATS = [(t, kind, p) for t, kind, p, _ in CATALOGUE if p is not None]
_TITLES = ",".join(t for t, _, _ in sorted(_QUEUE_STATS, key=lambda x: x[2]))
_QUEUES = "SELECT DISTINCT job_type FROM jobs UNION SELECT worker_type FROM workers"
_LOCKED = "SELECT job_type, string_agg(lock_by, ',' ORDER BY lock_by) AS workers FROM (SELECT DISTINCT job_type, lock_by FROM jobs WHERE status IN ('Pending', 'Queued', 'Running') AND lock_by IS NOT NULL) GROUP BY job_type"
_ACTIVITY = f"SELECT job_type, string_agg(CAST(n AS VARCHAR), ',' ORDER BY day) AS activity FROM (SELECT job_type, CAST(run_at AS DATE) AS day, count(*) AS n FROM jobs WHERE {_WEEK} GROUP BY ALL) GROUP BY job_type"
_EPOCH = "CAST(greatest(coalesce(floor(epoch({c})), 0), 0) AS BIGINT)"
_LISTED_WORKERS = f"SELECT id, worker_type AS queue, storage_name AS backend, {_EPOCH.format(c='started_at')} AS started_at, {_EPOCH.format(c='last_seen')} AS last_heartbeat, layers FROM workers"
_MATCH = """j.id = a.task_id AND j.job_type = a.queue AND j.lock_by = a.worker_id AND j.lock_at = a.lock_at AND j.attempts = a.started_attempts AND j.status = 'Running'
  AND (a.lease_token IS NULL OR EXISTS (SELECT 1 FROM workers w WHERE w.id = a.worker_id AND w.worker_type = a.queue AND w.lease_token = a.lease_token))"""
_ORPHAN = f"lock_by IS NOT NULL AND status IN ('Running', 'Queued') AND EXISTS (SELECT 1 FROM workers w WHERE w.id = jobs.lock_by AND w.worker_type = jobs.job_type AND {_STALE})"
_OVER = "attempts + 1 >= max_attempts"
_MINE = "status IN ('Queued', 'Running') AND lock_by = 'w-3'"
_LOCK = f"SELECT id, job_type, 'Running' AS status, attempts, CASE WHEN {_MINE} AND lock_at IS NOT NULL THEN lock_at ELSE {_NOW} END AS lock_at, 'w-3' AS lock_by FROM jobs WHERE {_DUE} AND ({_CLAIMABLE} OR ({_MINE})) AND id IN ({_IDS})"
_FRESH = "SELECT b.*, idempotency_key IS NULL OR (row_number() OVER (PARTITION BY job_type, idempotency_key ORDER BY id) = 1 AND NOT EXISTS (SELECT 1 FROM jobs j WHERE j.job_type = b.job_type AND j.idempotency_key = b.idempotency_key)) AS fresh FROM batch b"


_RULES = {
    "status": "status NOT IN ('Pending', 'Queued', 'Running', 'Done', 'Failed', 'Killed')",
    "attempts": "attempts < 0",
    "max_attempts": "max_attempts <= 0",
    "attempts_of_max": "attempts > max_attempts",
    "priority": "priority < 0",
}
_JUDGED = f"""SELECT a.*, j.max_attempts, j.attempts, j.lock_by AS held,
       j.id IS NOT NULL AND row_number() OVER (PARTITION BY a.task_id, a.queue, a.worker_id, a.started_attempts, j.id IS NOT NULL ORDER BY a.ok DESC) = 1 AS applied
FROM acks_again a LEFT JOIN jobs j ON {_MATCH}"""
_LISTED = sorted(_QUEUE_STATS, key=lambda x: x[2])


def _register(update: str, refused: str, seen: str, lease: str) -> str:
    asked, stored = "r.id IS NOT NULL", "w.id IS NOT NULL"
    take = f"({asked} AND (NOT {stored} OR {update}))"
    return _with(
        "workers requests",
        f"""SELECT coalesce(w.id, r.id) AS id, coalesce(w.worker_type, r.worker_type) AS worker_type,
       CASE WHEN {take} THEN r.storage_name ELSE w.storage_name END AS storage_name, CASE WHEN {take} THEN r.layers ELSE w.layers END AS layers,
       {seen.format(take=take, stored=stored)} AS last_seen, CASE WHEN {stored} THEN w.started_at ELSE {_NOW} END AS started_at, {lease.format(take=take)} AS lease_token,
       CASE WHEN NOT {asked} THEN 'unchanged' WHEN NOT {stored} THEN 'inserted' WHEN {update} THEN 'updated' ELSE '{refused}' END AS outcome
FROM workers w FULL OUTER JOIN requests r ON w.id = r.id AND w.worker_type = r.worker_type""",
    )


_SNAPSHOT = f"""SELECT job_type, count(*) AS total_jobs, {', '.join(f"{_n(f"status = '{s.capitalize()}'")} AS {s}_jobs" for s in ('pending', 'queued', 'running', 'done', 'failed', 'killed'))},
       {_STATS['ACTIVE_JOBS']} AS active_jobs, {_n(_HOUR)} AS jobs_past_hour, {_n(_DAY)} AS jobs_past_day, {_n(_WEEK)} AS jobs_past_7_days,
       max(run_at) AS most_recent_run_at, max(done_at) AS most_recent_done_at, {_NOW} AS snapshot_at FROM jobs GROUP BY job_type"""


def oracle_sql() -> dict[str, str]:
    row = lambda page: f"ORDER BY done_at DESC NULLS FIRST, run_at DESC, id LIMIT {page[0]} OFFSET {page[1]}"
    return {
        "claim_next": _with("jobs", f"SELECT {_taken('Running', _NO_TIME)} FROM (SELECT * FROM jobs WHERE job_type = 'click' AND {_CLAIMABLE} AND {_DUE} {_TOP} 10)"),
        "claim_state": _with(
            "jobs",
            f"""SELECT job_type, CASE WHEN t THEN 'Running' ELSE status END AS status, CASE WHEN t THEN 'w-new' ELSE lock_by END AS lock_by, count(*) AS n, count(CASE WHEN NOT t THEN done_at END) AS done
FROM (SELECT *, id IN (SELECT id FROM jobs WHERE job_type = 'click' AND {_CLAIMABLE} AND {_DUE} {_TOP} 10) AS t FROM jobs) GROUP BY 1, 2, 3""",
        ),
        "claim_all_queues": _with("jobs", f"SELECT {_taken('Running', _NO_TIME)} FROM ({_RANKED}) WHERE place <= 10"),
        "claim_for_workers": _with(
            "jobs workers",
            f"""SELECT j.id, j.job_type, 'Running' AS status, attempts, max_attempts, run_at, last_result, {_NOW} AS lock_at, w.id AS lock_by, {_NO_TIME} AS done_at, priority, idempotency_key FROM ({_RANKED}) j
JOIN (SELECT id, worker_type, 3 + ascii(right(id, 1)) % 4 AS n, sum(3 + ascii(right(id, 1)) % 4) OVER (PARTITION BY worker_type ORDER BY id) AS upto FROM workers) w
  ON w.worker_type = j.job_type AND j.place <= w.upto AND j.place > w.upto - w.n""",
        ),
        "claim_by_ids": _with("jobs", f"SELECT {_taken('Running', _NO_TIME)} FROM jobs WHERE job_type = 'click' AND {_CLAIMABLE} AND {_DUE} AND id IN ({_IDS})"),
        "get_jobs_queued": _with("jobs", f"SELECT {_taken('Queued', 'done_at')} FROM (SELECT * FROM jobs WHERE job_type = 'view' AND {_CLAIMABLE} AND {_DUE} {_TOP} 5)"),
        "lock_task_matrix": _with("jobs", _LOCK),
        "lock_task_in_queue": _with("jobs", f"SELECT id, status, lock_at, lock_by FROM ({_LOCK}) WHERE job_type = 'click'"),
        "ack_batch": _with(
            "jobs workers acks",
            f"""SELECT j.id, j.job_type, CASE WHEN a.ok THEN 'Done' WHEN j.max_attempts > j.attempts + 1 THEN 'Failed' ELSE 'Killed' END AS status,
       CAST(j.attempts + 1 AS INT) AS attempts, j.max_attempts, {_NOW} AS done_at, j.lock_by, j.lock_at FROM jobs j JOIN acks a ON {_MATCH}""",
        ),
        "ack_seconds": _with(
            "jobs workers acks",
            f"""SELECT j.id, j.job_type, CASE WHEN a.ok THEN 'Done' WHEN j.max_attempts > j.attempts + 1 THEN 'Failed' ELSE 'Killed' END AS status,
       CAST(j.attempts + 1 AS INT) AS attempts, j.max_attempts, {_NOW} AS done_at, j.lock_by, j.lock_at FROM jobs j JOIN acks a ON {_MATCH}""",
        ),
        "ack_stale": _with("jobs workers acks", f"SELECT task_id, queue, worker_id, started_attempts FROM acks a WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE {_MATCH})"),
        "ack_again": _with(
            "jobs workers acks_again",
            f"""SELECT task_id AS id, queue AS job_type, CASE WHEN ok THEN 'Done' WHEN max_attempts > attempts + 1 THEN 'Failed' ELSE 'Killed' END AS status, CAST(attempts + 1 AS INT) AS attempts,
       {_NOW} AS done_at, CASE WHEN ok THEN '{{"Ok":null}}' ELSE '{{"Err":""}}' END AS last_result FROM ({_JUDGED}) WHERE applied""",
        ),
        "ack_again_stale": _with("jobs workers acks_again", f"SELECT task_id, queue, worker_id, lock_at, started_attempts, ok FROM ({_JUDGED}) WHERE NOT applied"),
        "orphan_sweep": _with(
            "jobs workers",
            f"""SELECT id, job_type, CASE WHEN {_OVER} THEN 'Killed' ELSE 'Pending' END AS status, CAST(least(attempts + 1, max_attempts) AS INT) AS attempts,
       CASE WHEN {_OVER} OR last_result IS NULL THEN '{ABANDONED}' ELSE last_result END AS last_result, CAST(NULL AS VARCHAR) AS lock_by, {_NO_TIME} AS lock_at,
       CASE WHEN {_OVER} THEN {_NOW} END AS done_at FROM jobs WHERE {_ORPHAN}""",
        ),
        "orphan_counts": _with(
            "jobs workers",
            f"""SELECT job_type, CASE WHEN o AND {_OVER} THEN 'Killed' WHEN o THEN 'Pending' ELSE status END AS status, count(*) AS n, count(CASE WHEN NOT o THEN lock_by END) AS locked
FROM (SELECT *, {_ORPHAN} AS o FROM jobs) GROUP BY 1, 2""",
        ),
        "register_worker_upsert": _register(f"(w.lease_token IS NULL OR w.lease_token = r.lease_token OR w.{_STALE})", "rejected", "CASE WHEN {take} THEN " + _NOW + " ELSE w.last_seen END", "CASE WHEN {take} THEN r.lease_token ELSE w.lease_token END"),
        "admin_register_upsert": _register("w.lease_token IS NULL", "kept", "CASE WHEN {stored} THEN w.last_seen ELSE " + _NOW + " END", "w.lease_token"),
        "keep_alive": _with("workers", f"SELECT * REPLACE (CASE WHEN lease_token IS NOT NULL AND id NOT IN ('w-2', 'w-3') THEN {_NOW} ELSE last_seen END AS last_seen) FROM workers"),
        "enqueue_dedup": _with("jobs batch", f"SELECT id, job_type, 'Pending' AS status, CAST(0 AS INT) AS attempts, max_attempts, run_at, priority, idempotency_key FROM ({_FRESH}) WHERE fresh"),
        "enqueue_stream": _with("jobs batch", f"SELECT id, job_type, 'Pending' AS status, CAST(0 AS INT) AS attempts, max_attempts, run_at, priority, idempotency_key FROM ({_FRESH}) WHERE fresh"),
        "enqueue_all": _with("batch", "SELECT id, job_type, 'Pending' AS status, CAST(0 AS INT) AS attempts, max_attempts, run_at, priority, CAST(NULL AS VARCHAR) AS idempotency_key FROM batch"),
        "notify_payloads": _with(
            "jobs",
            f"""SELECT job_type, concat('{{"job_type":"', job_type, '","ids":["', string_agg(id, '","' ORDER BY id), '"]}}') AS payload
FROM (SELECT job_type, id, (row_number() OVER (PARTITION BY job_type ORDER BY id) - 1) // 100 AS chunk FROM jobs WHERE status = 'Pending' AND {_DUE}) GROUP BY job_type, chunk""",
        ),
        "enqueue_conflicts": _with("jobs batch", f"SELECT id, job_type, idempotency_key FROM ({_FRESH}) WHERE NOT fresh"),
        "notify_batches": _with("jobs", f"SELECT job_type, chunk, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT job_type, id, (row_number() OVER (PARTITION BY job_type ORDER BY id) - 1) // 100 AS chunk FROM jobs WHERE status = 'Pending' AND {_DUE}) GROUP BY job_type, chunk"),
        "notify_decode": "SELECT event_type AS job_type, lpad(CAST(event_id AS VARCHAR), 26, '0') AS ids FROM events WHERE event_id % 4 < 2",
        "notify_legacy": _with("jobs", """SELECT job_type, concat('{"job_type":"', job_type, '","id":"', id, '","run_at":"', strftime(run_at, '%Y-%m-%dT%H:%M:%S.%g'), '"}') AS payload FROM jobs"""),
        "notify_listen": _with("batch", f"SELECT job_type, id FROM (SELECT *, idempotency_key IS NULL OR row_number() OVER (PARTITION BY job_type, idempotency_key ORDER BY id) = 1 AS fresh FROM batch) WHERE fresh AND {_DUE}"),
        "notify_source": _with("batch", f"SELECT job_type, id FROM (SELECT *, idempotency_key IS NULL OR row_number() OVER (PARTITION BY job_type, idempotency_key ORDER BY id) = 1 AS fresh FROM batch) WHERE fresh AND {_DUE} AND job_type IN ('click', 'view')"),
        "arrays_to_rows": _with("jobs", "SELECT id, job_type, run_at, priority FROM jobs"),
        "tasks_over_caps": """WITH b AS (SELECT lpad(concat('n', CAST(event_id AS VARCHAR)), 26, '0') AS id,
    CASE WHEN event_id % 11 = 0 THEN 2 * (120 + event_id % 13) ELSE strlen(event_type) END AS queue_bytes,
    CASE WHEN event_id % 7 = 0 THEN 2 * (4090 + event_id % 13) ELSE strlen(props) END AS metadata_bytes,
    CASE WHEN event_id % 5 = 0 THEN 4 * (250 + event_id % 13) END AS key_bytes FROM events)
SELECT id, CAST(queue_bytes AS INT) AS queue_bytes, CAST(metadata_bytes AS INT) AS metadata_bytes, CAST(key_bytes AS INT) AS key_bytes FROM b WHERE queue_bytes > 255 OR metadata_bytes > 8192 OR key_bytes > 1024""",
        "capped_errors": _with(
            "jobs",
            """SELECT id, concat('{"Err":"', CASE WHEN strlen(t) <= 8192 THEN t ELSE concat(left(t, 4089), '…[truncated]') END, '"}') AS last_result
FROM (SELECT id, status, concat(CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'a' ELSE '' END, repeat('é', 4080 + CAST(id AS BIGINT) % 40)) AS t FROM jobs) WHERE status = 'Failed'""",
        ),
        "initial_heartbeat": _with(
            "jobs workers requests",
            f"""SELECT id, job_type AS queue, CASE WHEN {_OVER} THEN 'Killed' ELSE 'Pending' END AS what FROM jobs WHERE {_ORPHAN}
UNION ALL SELECT id, worker_type, lease_token FROM requests WHERE id IN ('w-new', 'w-1')""",
        ),
        "fetch_by_id": _with("jobs", f"SELECT {_COLUMNS} FROM jobs WHERE id = lpad('3', 26, '0') AND job_type IN ('click', 'view', 'purchase')"),
        "result_fields": _with("jobs", "SELECT id, status, CAST(json_extract(last_result, '$.Ok') AS BIGINT) AS ok, json_extract_string(last_result, '$.Err') AS err FROM jobs WHERE last_result IS NOT NULL"),
        "payload_fields": _with("jobs", "SELECT job_type, CAST(json_extract(job, '$.k') AS INT) AS k, count(*) AS n, CAST(sum(attempts) AS BIGINT) AS attempts, count(json_extract(metadata, '$.none')) AS none FROM jobs GROUP BY 1, 2"),
        "handled_columns": _with(
            "jobs",
            """SELECT id, CASE WHEN k % 10 <> 0 THEN 'Done' WHEN max_attempts > attempts + 1 THEN 'Failed' ELSE 'Killed' END AS status, CAST(attempts + 1 AS INT) AS attempts,
       CASE WHEN k % 10 <> 0 THEN concat('{"Ok":', CAST(k + 1 AS VARCHAR), '}') ELSE concat('{"Err":"no ', CAST(k AS VARCHAR), '"}') END AS last_result
FROM (SELECT *, CAST(json_extract(job, '$.k') AS INT) AS k FROM jobs WHERE status = 'Running')""",
        ),
        "waited": _with(
            "jobs",
            f"""SELECT id, CASE WHEN {_TERMINAL} THEN status ELSE 'Expired' END AS status, CASE WHEN {_TERMINAL} THEN last_result END AS result
FROM (SELECT *, greatest(max(run_at) OVER (), max(done_at) FILTER (WHERE {_TERMINAL}) OVER ()) AS latest FROM jobs)
WHERE {_TERMINAL} OR (CAST(id AS BIGINT) % 2 = 0 AND run_at + INTERVAL '10' MINUTE <= latest)""",
        ),
        "lost_workers": """SELECT id, worker_type, last_seen FROM (SELECT *, max(last_seen) OVER () AS latest FROM (
  SELECT concat('w-', CAST(user_id AS VARCHAR)) AS id, event_type AS worker_type, CAST(max(ts) AS TIMESTAMP) AS last_seen FROM events GROUP BY 1, 2)) WHERE last_seen <= latest - INTERVAL '6' HOUR""",
        "list_tasks_page1": _with("jobs", f"SELECT {_COLUMNS} FROM jobs WHERE job_type = 'click' AND status = 'Done' {row((20, 0))}"),
        "list_tasks_page2": _with("jobs", f"SELECT {_COLUMNS} FROM jobs WHERE job_type = 'click' AND status = 'Pending' {row((20, 20))}"),
        "list_all_tasks": _with("jobs", f"SELECT {_COLUMNS} FROM jobs WHERE status = 'Failed' {row((25, 25))}"),
        "list_tasks_late": _with(
            "jobs",
            f"""SELECT {_COLUMNS} FROM (SELECT *, row_number() OVER (ORDER BY done_at DESC NULLS FIRST, run_at DESC, id) AS nth, count(*) OVER () AS n FROM jobs WHERE status = 'Done')
WHERE nth > n // 50 * 25 AND nth <= n // 50 * 25 + 25""",
        ),
        "list_workers": _with("workers", f"{_LISTED_WORKERS} WHERE worker_type = 'click'"),
        "list_all_workers": _with("workers", _LISTED_WORKERS),
        "check_status": _with("jobs", f"SELECT id, status, last_result AS result FROM jobs WHERE {_TERMINAL} AND id IN ({_IDS})"),
        "wait_remaining": _with("jobs", f"SELECT id FROM ({_IDS}) WHERE id NOT IN (SELECT id FROM jobs WHERE {_TERMINAL})"),
        "metrics_global": _metrics("TRUE"),
        "metrics_by_queue": _metrics("job_type = 'click'"),
        "metrics_empty_queue": _metrics("job_type = 'no-such-queue'"),
        "metrics_report": _metrics_report(),
        "peak_hour": _with("jobs", "SELECT max(n) AS peak_hour_jobs FROM (SELECT count(*) AS n FROM jobs GROUP BY extract(hour FROM run_at))"),
        "queue_rollup": _with("jobs", f"SELECT job_type, {', '.join(f'{_STATS[t]} AS {t.lower()}' for t, _, _ in _QUEUE_STATS)} FROM jobs GROUP BY job_type"),
        "queue_stats_long": _with(
            "jobs",
            f"SELECT job_type, title, stat_type, number, CAST(priority AS INT) AS priority FROM (SELECT job_type, {', '.join(f'{_STATS[t]} AS {t}' for t, _, _ in _QUEUE_STATS)} FROM jobs GROUP BY job_type) w, LATERAL (VALUES {', '.join(f"('{t}', '{k}', {'CAST(NULL AS DOUBLE)' if k == 'Timestamp' else f'CAST({t} AS DOUBLE)'}, {p})" for t, k, p in _QUEUE_STATS)}) v(title, stat_type, number, priority)",
        ),
        "queue_types_union": _with("jobs workers", _QUEUES),
        "locked_workers": _with("jobs", _LOCKED),
        "daily_activity": _with("jobs", _ACTIVITY),
        "queue_info_flat": _with(
            "jobs workers",
            f"""SELECT q.job_type AS name, CASE WHEN j.job_type IS NULL THEN 0 ELSE CAST({len(_QUEUE_STATS)} AS BIGINT) END AS n_stats, CASE WHEN j.job_type IS NULL THEN '' ELSE '{_TITLES}' END AS titles,
       coalesce(l.workers, '') AS workers, coalesce(a.activity, '') AS activity
FROM ({_QUEUES}) q LEFT JOIN (SELECT DISTINCT job_type FROM jobs) j ON j.job_type = q.job_type LEFT JOIN ({_LOCKED}) l ON l.job_type = q.job_type LEFT JOIN ({_ACTIVITY}) a ON a.job_type = q.job_type""",
        ),
        "queue_info": _with(
            "jobs workers",
            f"""SELECT q.job_type AS name, coalesce(l.workers, '') AS workers, coalesce(a.activity, '') AS activity, CAST(v.nth AS INT) AS nth, v.title, v.stat_type, v.number, CAST(v.priority AS INT) AS priority
FROM ({_QUEUES}) q LEFT JOIN ({_LOCKED}) l ON l.job_type = q.job_type LEFT JOIN ({_ACTIVITY}) a ON a.job_type = q.job_type
LEFT JOIN (SELECT job_type, nth, title, stat_type, number, priority FROM (SELECT job_type, {', '.join(f'{_STATS[t]} AS {t}' for t, _, _ in _QUEUE_STATS)} FROM jobs GROUP BY job_type) w,
  LATERAL (VALUES {', '.join(f"({k}, '{t}', '{kind}', {'CAST(NULL AS DOUBLE)' if kind == 'Timestamp' else f'CAST({t} AS DOUBLE)'}, {p})" for k, (t, kind, p) in enumerate(_LISTED))}) v(nth, title, stat_type, number, priority)) v ON v.job_type = q.job_type""",
        ),
        "snapshot": _with("jobs", _SNAPSHOT),
        "snapshot_incremental": _with(
            "jobs workers acks",
            f""", hit AS (SELECT a.task_id, a.ok FROM jobs j JOIN acks a ON {_MATCH}),
after_ AS (SELECT j.* REPLACE (CASE WHEN h.task_id IS NULL THEN status WHEN h.ok THEN 'Done' WHEN max_attempts > attempts + 1 THEN 'Failed' ELSE 'Killed' END AS status,
                               CASE WHEN h.task_id IS NULL THEN done_at ELSE {_NOW} END AS done_at) FROM jobs j LEFT JOIN hit h ON h.task_id = j.id)
{_SNAPSHOT.replace("FROM jobs", "FROM after_")}""",
        ),
        "claimable_count": _with("jobs", f"SELECT job_type, count(*) AS claimable FROM jobs WHERE {_CLAIMABLE} AND {_DUE} GROUP BY job_type"),
        "terminal_counts": _with("jobs", f"SELECT status, count(*) AS n FROM jobs WHERE {_TERMINAL} GROUP BY status"),
        "delayed_jobs": _with("jobs", f"SELECT id, job_type, run_at FROM jobs WHERE {_CLAIMABLE} AND NOT {_DUE}"),
        "repair_orphan_locks": _with("jobs", f"SELECT id, job_type, 'Pending' AS status, CAST(NULL AS VARCHAR) AS lock_by, {_NO_TIME} AS lock_at FROM jobs WHERE status IN ('Running', 'Queued') AND lock_by IN ('w-2', 'w-5')"),
        "backfill": _with("jobs", "SELECT CAST(coalesce(nullif(priority, 2), 0) AS INT) AS priority, count(*) AS n, max(lock_at) AS last_lock FROM jobs GROUP BY 1"),
        "dedupe_workers": _with("workers", "SELECT id, worker_type, lease_token FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY worker_type) AS nth FROM workers) WHERE nth = 1"),
        "constraint_violations": _with("broken", " UNION ALL ".join(f"SELECT id, '{rule}' AS rule FROM broken WHERE {where}" for rule, where in _RULES.items())),
        "fk_violations": _with("workers broken", "SELECT id, lock_by, job_type FROM broken b WHERE lock_by IS NOT NULL AND NOT EXISTS (SELECT 1 FROM workers w WHERE w.id = b.lock_by AND w.worker_type = b.job_type)"),
        "unique_violations": _with("broken", "SELECT job_type, idempotency_key, count(*) AS n FROM broken WHERE idempotency_key IS NOT NULL GROUP BY ALL HAVING count(*) > 1"),
    }
