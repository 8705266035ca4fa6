"""SQL that gives the same rows as the registered queries, for checking."""

from __future__ import annotations

from corpusmill.plans.queries import (
    DATE,
    MAXIMUM,
    QUOTA,
    SEQUENCE_LENGTH,
    TARGET,
    VERSION,
    VOCAB_SIZE,
)
from corpusmill.schemas import SOURCE_TYPES, STATES, TRANSITIONS

N = SEQUENCE_LENGTH
# Fixed value: whitespace as a class body for the SQL engine's patterns.
WHITESPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\x{200c}\x{200d}\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}"
WORDS = f"regexp_extract_all(text, '[{WORD}]+|[^{WORD}{WHITESPACE}]+')"
NORMAL = f"trim(regexp_replace(text, '[{WHITESPACE}]+', ' ', 'g'))"
PAYLOAD = (
    "regexp_replace(CAST(to_json({'text': text}) AS VARCHAR), '^\\{\"text\":', '{\"text\": ')"
)


def _strings(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


SIZED = f"""
sized AS (
  SELECT source AS source_id, doc_id AS pos, {PAYLOAD} AS payload,
         CAST(strlen({PAYLOAD}) + 1 AS BIGINT) AS size
  FROM documents
),
offs AS (
  SELECT *, CAST(sum(size) OVER w AS BIGINT) AS end_offset, row_number() OVER w AS record_index
  FROM sized
  WINDOW w AS (PARTITION BY source_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
),
kept AS (SELECT * FROM offs WHERE end_offset <= {QUOTA})"""

WALK = f"""
walk(source_id, n, border) AS (
  SELECT DISTINCT source_id, 0, CAST(0 AS BIGINT) FROM offs
  UNION ALL
  SELECT source_id, n + 1, border FROM (
    SELECT w.source_id, w.n,
      (SELECT min(k.end_offset) FROM offs k
       WHERE k.source_id = w.source_id AND k.end_offset >= w.border + {TARGET}) AS border
    FROM walk w)
  WHERE border IS NOT NULL
),
assigned AS (
  SELECT k.source_id, k.pos, k.size, k.end_offset, k.record_index, k.payload,
    1 + (SELECT count(*) FROM walk w
         WHERE w.source_id = k.source_id AND w.n > 0 AND w.border < k.end_offset) AS shard_sequence
  FROM offs k
),
shards AS (
  SELECT source_id, shard_sequence, CAST(sum(size) AS BIGINT) AS size_bytes,
    count(*) AS record_count, max(pos) AS last_pos, max(record_index) AS record_index,
    sha256(string_agg(payload || chr(10), '' ORDER BY pos)) AS checksum,
    'run-' || source_id AS run_id,
    'run-' || source_id || '-' || printf('%06d', shard_sequence) AS shard_id,
    source_id || '/' || source_id || '/version={VERSION}/ingestion_date={DATE}/run_id=run-'
      || source_id || '/shard-' || printf('%06d', shard_sequence) || '.txt' AS object_key
  FROM assigned GROUP BY source_id, shard_sequence
)"""

REGISTRY = f"""
registry AS (
  SELECT CAST(o AS INTEGER) AS ordinal, source_id,
    {_strings(SOURCE_TYPES)}[1 + o % 4] AS source_type,
    'https://example.test/' || source_id AS source_url,
    'CC0-1.0' AS license_name, 'https://example.test/license' AS license_url,
    CAST(40000 + 5000 * (o % 9) AS BIGINT) AS max_bytes,
    CASE WHEN o % 4 = 0 THEN source_id END AS dataset_id,
    CAST(NULL AS VARCHAR) AS dataset_config,
    o % 7 <> 3 AS enabled, 'source ' || o AS notes,
    {_strings(STATES)}[1 + o % 8] AS status
  FROM (SELECT source_id, row_number() OVER (ORDER BY source_id) - 1 AS o
        FROM (SELECT DISTINCT source AS source_id FROM documents)))"""

STATE_OF_SOURCE = """
states AS (
  SELECT r.source_id, r.ordinal, r.status, r.max_bytes,
    CASE WHEN r.ordinal % 5 <> 4 THEN 'run-' || r.source_id END AS current_run_id,
    coalesce(t.v, 0) AS verified_bytes
  FROM registry r LEFT JOIN
    (SELECT source_id, CAST(sum(size_bytes) AS BIGINT) AS v FROM shards GROUP BY 1) t
    USING (source_id))"""

LISTING = """
listing AS (
  SELECT object_key, size_bytes - CASE WHEN shard_sequence % 4 = 2 THEN 1 ELSE 0 END AS length
  FROM shards WHERE shard_sequence % 5 <> 3),
bad AS (
  SELECT s.*, l.length,
    CASE WHEN l.length IS NULL THEN 'stored shard is missing'
         ELSE 'stored shard size does not match metadata' END AS message
  FROM shards s LEFT JOIN listing l USING (object_key)
  WHERE l.length IS NULL OR l.length <> s.size_bytes)"""

HISTORY = """
history AS (
  SELECT CAST(user_id AS VARCHAR) AS id, event_id AS seq, ts,
    CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'RUNNING'
      WHEN 'click' THEN 'PAUSED' WHEN 'purchase' THEN 'COMPLETED' WHEN 'error' THEN 'FAILED'
    END AS status,
    CASE WHEN event_type = 'error' THEN props END AS error
  FROM events)"""

_PAIRS = ", ".join(f"('{a}', '{b}')" for a, b in TRANSITIONS)
ALLOWED = f"allowed(a, b) AS (VALUES {_PAIRS})"

TOKENS = f"""
token_docs AS (
  SELECT doc_id, source,
    list_transform({WORDS}, lambda w: CAST((unicode(w) * 31 + length(w)) % {VOCAB_SIZE} AS INTEGER)) AS ids
  FROM documents)"""

BLOCKS = f"""
stream AS (
  SELECT id, row_number() OVER (ORDER BY doc_id, k) - 1 AS g
  FROM (SELECT doc_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS k FROM token_docs)),
total AS (SELECT count(*) AS t FROM stream),
slots AS (
  SELECT g // {N} AS block_id, g % {N} AS slot, id FROM stream
  UNION ALL
  SELECT g // {N} - 1, {N}, id FROM stream WHERE g % {N} = 0 AND g > 0),
blocks AS (
  SELECT block_id, list(id ORDER BY slot) AS ids FROM slots
  GROUP BY block_id HAVING count(*) = {N + 1})"""


def _with(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


def _times(names) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S.%f') AS {n}" for n in names)


SHARDS = (SIZED, WALK)

ORACLES: dict[str, str] = {
    "line_scan": _with(
        *SHARDS,
        select="""SELECT source_id, shard_sequence, payload,
          row_number() OVER w AS record_index, CAST(sum(size) OVER w AS BIGINT) AS end_offset
        FROM assigned
        WINDOW w AS (PARTITION BY source_id, shard_sequence ORDER BY pos ROWS UNBOUNDED PRECEDING)""",
    ),
    "dataset_text_scan": f"""SELECT doc_id, {PAYLOAD} AS payload,
        CAST(strlen({PAYLOAD}) + 1 AS BIGINT) AS size FROM documents""",
    "manifest_scan": """WITH f AS (
          SELECT greatest(4, (SELECT count(*) FROM documents) // 100000) AS files),
        placed AS (SELECT doc_id % files AS n, doc_id, text FROM documents, f)
        SELECT CAST(n + (n // 2) AS INTEGER) AS file_index,
          row_number() OVER (PARTITION BY n ORDER BY doc_id) AS record_index,
          CAST(to_json({'doc_id': doc_id, 'text': text}) AS VARCHAR) AS payload
        FROM placed""",
    "resume_from_cursor": _with(
        SIZED,
        select=f"""SELECT source_id, pos, size, end_offset, record_index FROM (
          SELECT o.source_id, o.pos, o.size, c.verified,
            CAST(sum(o.size) OVER w AS BIGINT) AS end_offset, row_number() OVER w AS record_index
          FROM offs o LEFT JOIN (
            SELECT source_id, max(pos) AS cursor, sum(size) AS verified
            FROM offs WHERE end_offset <= {QUOTA // 2} GROUP BY 1) c USING (source_id)
          WHERE c.cursor IS NULL OR o.pos > c.cursor
          WINDOW w AS (PARTITION BY o.source_id ORDER BY o.pos ROWS UNBOUNDED PRECEDING))
        WHERE end_offset <= {QUOTA} - coalesce(verified, 0)""",
    ),
    "resume_byte_offset": _with(
        *SHARDS,
        f"""lines AS (
          SELECT dense_rank() OVER (ORDER BY source_id, shard_sequence) - 1 AS file_index, payload, size,
            row_number() OVER w AS n, CAST(sum(size) OVER w AS BIGINT) AS end_offset
          FROM assigned
          WINDOW w AS (PARTITION BY source_id, shard_sequence ORDER BY pos ROWS UNBOUNDED PRECEDING)),
        rest AS (
          SELECT CAST(file_index AS INTEGER) AS file_index, end_offset, payload,
            row_number() OVER w AS total_records, CAST(sum(size) OVER w AS BIGINT) AS total_bytes
          FROM lines, (SELECT count(*) // 2 AS middle FROM shards)
          WHERE file_index > middle OR (file_index = middle AND n > 1)
          WINDOW w AS (ORDER BY file_index, n ROWS UNBOUNDED PRECEDING))""",
        select=f"SELECT * FROM rest WHERE total_bytes <= {4 * QUOTA}",
    ),
    "resume_file_record": f"""WITH f AS (
          SELECT greatest(4, (SELECT count(*) FROM documents) // 100000) AS files),
        placed AS (SELECT doc_id % files AS n, doc_id, text FROM documents, f),
        numbered AS (
          SELECT CAST(n + (n // 2) AS INTEGER) AS file_index,
            row_number() OVER (PARTITION BY n ORDER BY doc_id) AS record_index,
            CAST(to_json({{'doc_id': doc_id, 'text': text}}) AS VARCHAR) AS payload
          FROM placed)
        SELECT file_index, record_index, payload FROM (
          SELECT *, sum(strlen(payload) + 1) OVER (ORDER BY file_index, record_index ROWS UNBOUNDED PRECEDING) AS total
          FROM numbered WHERE file_index > 1 OR (file_index = 1 AND record_index > 3))
        WHERE total <= {4 * QUOTA}""",
    "quota_prefix": _with(
        SIZED, select="SELECT source_id, pos, size, end_offset, record_index FROM kept"
    ),
    "record_limit": _with(
        SIZED,
        select="""SELECT source_id, pos, size, end_offset, record_index
        FROM offs WHERE record_index <= 25""",
    ),
    "source_plan": _with(
        REGISTRY,
        select="""SELECT ordinal, source_id, source_type,
          CASE source_type WHEN 'huggingface_dataset' THEN 'dataset'
            WHEN 'dolma_manifest' THEN 'manifest' ELSE 'lines' END AS reader, max_bytes
        FROM registry WHERE enabled""",
    ),
    "shard_assign": _with(
        *SHARDS,
        select="""SELECT source_id, pos, size, end_offset, record_index, shard_sequence
        FROM assigned""",
    ),
    "oversize_guard": _with(
        SIZED,
        select="""SELECT source_id, pos, size, true AS strict FROM offs WHERE size > 4096
        UNION ALL
        SELECT source_id, pos, size, false FROM offs WHERE size > 4096 AND record_index = 1""",
    ),
    "shard_stats": _with(
        *SHARDS,
        select="""SELECT source_id, shard_sequence, size_bytes, record_count, last_pos, checksum
        FROM shards""",
    ),
    "shard_layout": _with(
        *SHARDS,
        select=f"""SELECT source_id, shard_sequence, object_key,
          source_id || '/version={VERSION}/run_id=' || run_id || '/manifest.json' AS manifest_key
        FROM shards""",
    ),
    "shard_write": _with(
        *SHARDS,
        select="""SELECT source_id, shard_sequence, size_bytes, record_count, last_pos, checksum,
          object_key, size_bytes AS stored_size_bytes FROM shards""",
    ),
    "verify_written": _with(
        *SHARDS,
        select="""SELECT source_id, shard_sequence,
          source_id || '/shard-' || printf('%06d', shard_sequence) || '.txt' AS object_key,
          size_bytes,
          CASE WHEN shard_sequence % 4 <> 2
            THEN size_bytes + CASE WHEN shard_sequence % 3 = 0 THEN 1 ELSE 0 END ELSE -1 END AS length
        FROM shards WHERE shard_sequence % 4 = 2 OR shard_sequence % 3 = 0""",
    ),
    "token_ids_sink": _with(
        TOKENS,
        select="""SELECT array_to_string(ids, ' ') AS ids,
          (SELECT CAST(sum(len(ids)) AS BIGINT) FROM token_docs) AS total FROM token_docs""",
    ),
    "register_sources": _with(
        REGISTRY,
        select="""SELECT source_id,
          CASE WHEN ordinal % 2 = 0 THEN 'new ' ELSE 'old ' END || source_id AS source_name,
          max_bytes AS configured_quota_bytes,
          CASE WHEN ordinal % 3 <> 0 THEN 'PAUSED' ELSE 'PENDING' END AS status,
          CAST(CASE WHEN ordinal % 3 <> 0 THEN ordinal * 100 ELSE 0 END AS BIGINT) AS verified_bytes,
          CASE WHEN ordinal % 3 <> 0 THEN '{"record_index":1}' END AS checkpoint,
          CASE WHEN ordinal % 3 <> 0 THEN '2026-01-01 00:00:00' ELSE '2026-02-01 00:00:00' END AS created_at,
          CASE WHEN ordinal % 2 = 0 THEN '2026-02-01 00:00:00' ELSE '2026-01-01 00:00:00' END AS updated_at
        FROM registry WHERE ordinal % 3 <> 0 OR ordinal % 2 = 0""",
    ),
    "open_run": _with(
        REGISTRY,
        select="""SELECT source_id,
          CASE WHEN ordinal % 2 = 0 THEN 'old-' ELSE 'new-' END || source_id AS current_run_id,
          CASE WHEN ordinal % 2 = 0 THEN 'v1' ELSE 'v2' END AS current_version_id
        FROM registry""",
    ),
    "commit_shards": _with(
        *SHARDS,
        select="""SELECT shard_id, source_id, shard_sequence, size_bytes AS stored_size_bytes
        FROM shards WHERE shard_sequence % 2 = 0""",
    ),
    "commit_conflicts": _with(
        *SHARDS,
        select="""SELECT shard_id, 'UPLOADING' AS stored_status
        FROM shards WHERE shard_sequence % 3 = 1""",
    ),
    "source_totals": _with(
        *SHARDS,
        REGISTRY,
        select="""SELECT r.source_id, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS verified_bytes,
          CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS downloaded_bytes,
          count(s.shard_id) AS completed_shard_count
        FROM registry r LEFT JOIN shards s USING (source_id) GROUP BY r.source_id""",
    ),
    "run_totals": _with(
        *SHARDS,
        REGISTRY,
        select="""SELECT r.run_id, r.source_id,
          CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS verified_bytes,
          CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS downloaded_bytes,
          count(s.shard_id) AS completed_shard_count
        FROM (SELECT 'run-' || source_id || unnest(['-a', '-b', '-c']) AS run_id, source_id FROM registry) r
        LEFT JOIN shards s
          ON r.run_id = s.run_id || CASE WHEN s.shard_sequence <= 2 THEN '-a' ELSE '-b' END
        GROUP BY r.run_id, r.source_id""",
    ),
    "resume_cursor": _with(
        *SHARDS,
        REGISTRY,
        select="""SELECT r.source_id, coalesce(c.checkpoint, '{}') AS checkpoint
        FROM (SELECT source_id FROM registry UNION ALL SELECT source_id || '-new' FROM registry) r
        LEFT JOIN (
          SELECT source_id, '{"file_index":0,"record_index":' ||
            arg_max(record_index, shard_sequence) || '}' AS checkpoint
          FROM shards WHERE shard_sequence % 4 <> 0 GROUP BY source_id) c USING (source_id)""",
    ),
    "apply_status": _with(
        HISTORY,
        select=f"""SELECT id, status, last_error,
          {_times(["updated_at", "last_started_at", "last_completed_at", "paused_at", "failed_at"])}
        FROM (SELECT id, arg_max(status, seq) AS status,
            arg_max({{'e': error}}, seq).e AS last_error, arg_max(ts, seq) AS updated_at,
            arg_max(ts, seq) FILTER (status = 'RUNNING') AS last_started_at,
            arg_max(ts, seq) FILTER (status = 'COMPLETED') AS last_completed_at,
            arg_max(ts, seq) FILTER (status = 'PAUSED') AS paused_at,
            arg_max(ts, seq) FILTER (status = 'FAILED') AS failed_at
          FROM history GROUP BY id)""",
    ),
    "lifecycle_audit": _with(
        HISTORY,
        ALLOWED,
        select="""SELECT id, seq, status, previous FROM (
          SELECT id, seq, status,
            coalesce(lag(status) OVER (PARTITION BY id ORDER BY seq), 'PENDING') AS previous
          FROM history)
        WHERE previous <> status AND (previous, status) NOT IN (SELECT (a, b) FROM allowed)""",
    ),
    "quota_reached": _with(
        *SHARDS,
        REGISTRY,
        STATE_OF_SOURCE,
        select="""SELECT source_id, max_bytes, verified_bytes, verified_bytes >= max_bytes AS reached
        FROM states""",
    ),
    "source_by_id": _with(
        REGISTRY,
        select="""SELECT source_id, ordinal, max_bytes FROM registry
        WHERE source_id = (SELECT max(source_id) FROM registry)""",
    ),
    "run_by_id": _with(
        REGISTRY,
        select="""SELECT 'run-' || source_id AS run_id, source_id, ordinal
        FROM registry WHERE ordinal % 3 = 1""",
    ),
    "run_shards": _with(
        *SHARDS,
        select="""SELECT shard_sequence, 'raw' AS bucket, object_key,
          size_bytes AS stored_size_bytes, 'sha256' AS checksum_algorithm, checksum, checksum AS etag
        FROM shards WHERE source_id = (SELECT min(source) FROM documents) ORDER BY shard_sequence""",
    ),
    "source_listing": _with(
        REGISTRY,
        select="SELECT source_id, source_type, max_bytes, enabled FROM registry ORDER BY source_id",
    ),
    "event_log": f"""SELECT event_type, event_level, n, {_times(["first_at", "last_at"])} FROM (
        SELECT event_type, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS event_level,
          count(*) AS n, min(ts) AS first_at, max(ts) AS last_at
        FROM events GROUP BY event_type)""",
    "run_manifest": _with(
        *SHARDS,
        REGISTRY,
        select=f"""SELECT 'run-' || r.source_id AS run_id, r.source_id, '{VERSION}' AS version_id,
          CAST(to_json({{
            'checksum_algorithm': 'SHA-256',
            'completed_at': CASE WHEN enabled THEN '2025-02-03 11:00:00' END,
            'run_id': 'run-' || r.source_id,
            'shards': coalesce(l.shards, []),
            'source': {{'source_type': source_type, 'source_uri': source_url,
              'license_name': license_name, 'license_url': license_url, 'notes': notes,
              'dataset_id': dataset_id, 'dataset_config': dataset_config}},
            'source_id': r.source_id,
            'started_at': '2025-02-03 10:30:00',
            'status': CASE WHEN enabled THEN 'COMPLETED' ELSE 'PAUSED' END,
            'total_downloaded_bytes': coalesce(l.bytes, 0),
            'total_shards': coalesce(l.n, 0),
            'total_stored_bytes': coalesce(l.bytes, 0),
            'version_id': '{VERSION}'}}) AS VARCHAR) AS manifest
        FROM registry r LEFT JOIN (
          SELECT source_id, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes,
            list({{'shard_sequence': shard_sequence, 'bucket': 'raw', 'object_key': object_key,
              'stored_size_bytes': size_bytes, 'checksum_algorithm': 'sha256',
              'checksum': checksum, 'etag': CAST(NULL AS VARCHAR)}} ORDER BY shard_sequence) AS shards
          FROM shards GROUP BY source_id) l USING (source_id)""",
    ),
    "reconcile_interrupted": _with(
        *SHARDS,
        REGISTRY,
        STATE_OF_SOURCE,
        """active AS (SELECT * FROM states WHERE status IN ('RUNNING', 'RETRYING', 'PAUSE_REQUESTED')),
        steps AS (
          SELECT *, 0 AS step, 'PAUSE_REQUESTED' AS to_status FROM active WHERE status = 'RUNNING'
          UNION ALL
          SELECT *, CASE WHEN status = 'RUNNING' THEN 1 ELSE 0 END, 'PAUSED' FROM active)""",
        select="""SELECT 'source' AS entity, source_id AS id, step, to_status AS status,
          CASE WHEN to_status = 'PAUSED' THEN 'startup reconciliation paused interrupted run' END AS error
        FROM steps
        UNION ALL
        SELECT 'run', current_run_id, step, to_status, NULL FROM steps WHERE current_run_id IS NOT NULL""",
    ),
    "reconcile_events": _with(
        *SHARDS,
        REGISTRY,
        STATE_OF_SOURCE,
        select="""SELECT current_run_id AS run_id, source_id, CAST(NULL AS VARCHAR) AS shard_id,
          'startup_run_paused' AS event_type, 'WARNING' AS event_level,
          'interrupted run made resumable' AS message, CAST(NULL AS VARCHAR) AS event_data
        FROM states WHERE status IN ('RUNNING', 'RETRYING', 'PAUSE_REQUESTED')""",
    ),
    "reconcile_shards": _with(
        *SHARDS,
        LISTING,
        select="""SELECT source_id, run_id, shard_id, shard_sequence, object_key,
          size_bytes AS stored_size_bytes, coalesce(length, -1) AS length, message FROM bad""",
    ),
    "reconcile_failures": _with(
        *SHARDS,
        REGISTRY,
        LISTING,
        ALLOWED,
        """judged AS (
          SELECT f.source_id, f.run_id, f.error, r.status,
            r.status = 'FAILED' OR (r.status, 'FAILED') IN (SELECT (a, b) FROM allowed) AS may
          FROM (SELECT source_id, run_id, arg_max(message, shard_sequence) AS error
                FROM bad GROUP BY 1, 2) f JOIN registry r USING (source_id))""",
        select="""SELECT 'source' AS entity, source_id AS id, 'FAILED' AS status, error FROM judged WHERE may
        UNION ALL SELECT 'run', run_id, 'FAILED', error FROM judged WHERE may
        UNION ALL SELECT 'violation', source_id, status || ' -> FAILED', error FROM judged WHERE NOT may""",
    ),
    "listing_audit": _with(
        *SHARDS,
        LISTING,
        select="""SELECT object_key,
          CASE WHEN length IS NULL THEN 'missing' ELSE 'size_mismatch' END AS finding FROM bad
        UNION ALL
        SELECT object_key || '.copy', 'orphan' FROM shards WHERE shard_sequence = 1""",
    ),
    "incomplete_files": _with(
        *SHARDS,
        select="""SELECT path, kind, 'quarantine/20260714T103000Z/' || path AS destination FROM (
          SELECT source_id || '/shard-' || printf('%06d', shard_sequence) || '.' || k AS path,
            k AS kind, shard_sequence
          FROM (SELECT *, ['partial', 'ready', 'uploading', 'txt']
                  [1 + (shard_sequence + length(source_id)) % 4] AS k FROM shards))
        WHERE kind <> 'txt' AND shard_sequence % 3 <> 0""",
    ),
    "registry_check": _with(
        REGISTRY,
        """broken AS (
          SELECT CASE WHEN ordinal % 8 = 1 THEN source_id WHEN ordinal % 8 = 5 THEN '' END AS source_id,
            CASE WHEN ordinal % 3 = 0 THEN license_name END AS license_name,
            -max_bytes AS max_bytes, enabled
          FROM registry WHERE ordinal % 4 = 1),
        entries AS (
          SELECT source_id, license_name, max_bytes, enabled FROM registry
          UNION ALL SELECT * FROM broken)""",
        select="""SELECT source_id, 'missing id' AS problem FROM entries WHERE source_id IS NULL
        UNION ALL SELECT source_id, 'id must not be empty' FROM entries WHERE source_id = ''
        UNION ALL SELECT source_id, 'missing license_name' FROM entries WHERE license_name IS NULL
        UNION ALL SELECT source_id, 'max_bytes must be positive' FROM entries WHERE max_bytes <= 0
        UNION ALL SELECT source_id, 'source IDs must be unique' FROM entries
          WHERE source_id IS NOT NULL GROUP BY source_id HAVING count(*) > 1
        UNION ALL SELECT NULL, 'enabled source max_bytes exceed raw budget' FROM entries
          HAVING sum(CASE WHEN enabled THEN max_bytes END) > 100000""",
    ),
    "progress_report": _with(
        *SHARDS,
        REGISTRY,
        select="""SELECT source_id, shard_sequence, size_bytes AS stored_size_bytes, verified_bytes,
          quota_bytes, round(verified_bytes / quota_bytes, 6) AS quota_share,
          round(size_bytes / greatest((shard_sequence % 3) * 0.5, 1e-6), 2) AS bytes_per_second
        FROM (SELECT s.*, r.max_bytes AS quota_bytes,
            CAST(sum(size_bytes) OVER (PARTITION BY s.source_id ORDER BY shard_sequence) AS BIGINT) AS verified_bytes
          FROM shards s JOIN registry r USING (source_id))""",
    ),
    "nonempty_sources": """
        SELECT DISTINCT 'role-' || role AS source_id,
          'source produced no records: role-' || role AS problem
        FROM conversations""",
    "run_outcome": _with(
        *SHARDS,
        REGISTRY,
        STATE_OF_SOURCE,
        select="""SELECT source_id, status, action,
          CASE WHEN action = 'error' THEN 'source is already active: ' || source_id END AS error
        FROM (SELECT *, CASE WHEN status = 'COMPLETED' THEN 'skip'
            WHEN verified_bytes >= max_bytes AND status IN ('RUNNING', 'PAUSED', 'RETRYING', 'FAILED') THEN 'complete'
            WHEN verified_bytes >= max_bytes THEN 'violation'
            WHEN status IN ('PENDING', 'PAUSED') THEN 'run'
            WHEN status = 'FAILED' THEN 'retry' ELSE 'error' END AS action FROM states)""",
    ),
    "assemble_documents": f"""WITH lines AS (
          SELECT source, doc_id * 16777216 + k AS line_no,
            regexp_replace(line, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g') AS value
          FROM (SELECT source, doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS k
                FROM (SELECT source, doc_id, list_append(string_split(text, chr(10)), ' ') AS l FROM documents))),
        islands AS (
          SELECT *, sum(CASE WHEN value = '' THEN 1 ELSE 0 END)
            OVER (PARTITION BY source ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS island
          FROM lines)
        SELECT * FROM (
          SELECT source AS file, min(line_no) AS first_line,
            trim(regexp_replace(string_agg(value, ' ' ORDER BY line_no), '[{WHITESPACE}]+', ' ', 'g')) AS text
          FROM islands WHERE value <> '' GROUP BY source, island)
        WHERE length(text) >= 40""",
    "text_file_documents": f"""SELECT text, count(*) AS n FROM (
          SELECT {NORMAL} AS text FROM documents) WHERE length(text) >= 40 GROUP BY text""",
    "normalize_text": f"""SELECT page_id, {NORMAL} AS text FROM (
          SELECT page_id, html AS text FROM pages
          UNION ALL SELECT -doc_id - 1, text FROM documents)""",
    "min_chars_filter": f"""SELECT doc_id, source, length({NORMAL}) AS chars
        FROM documents WHERE length({NORMAL}) >= 200""",
    "require_documents": f"""SELECT source, count(*) AS documents
        FROM documents WHERE length({NORMAL}) >= 20 GROUP BY source""",
    "split_last": """SELECT doc_id, source,
          CASE WHEN doc_id = max(doc_id) OVER (PARTITION BY source) THEN 'validation' ELSE 'train' END AS source_split,
          CASE WHEN doc_id = max(doc_id) OVER () THEN 'validation' ELSE 'train' END AS overall_split
        FROM documents""",
    "pretoken_counts": f"""SELECT word, count(*) AS n
        FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word""",
    "encode_round_trip": f"""SELECT doc_id, array_to_string({WORDS}, '') AS joined FROM documents""",
    "token_counts": f"""WITH c AS (
          SELECT source, count(*) AS documents, CAST(sum(len({WORDS})) AS BIGINT) AS tokens
          FROM documents GROUP BY source)
        SELECT * FROM c UNION ALL SELECT '*', CAST(sum(documents) AS BIGINT), CAST(sum(tokens) AS BIGINT) FROM c""",
    "vocab_range_check": _with(
        TOKENS,
        select=f"""SELECT doc_id, list_filter(ids, lambda x: x >= {VOCAB_SIZE - 400})[1] AS bad_id
        FROM token_docs WHERE len(list_filter(ids, lambda x: x >= {VOCAB_SIZE - 400})) > 0""",
    ),
    "pack_blocks": _with(
        TOKENS, BLOCKS, select="SELECT block_id, array_to_string(ids, ' ') AS ids FROM blocks"
    ),
    "pack_metadata": _with(
        TOKENS,
        select=f"""SELECT {N} AS sequence_length, {VOCAB_SIZE} AS vocab_size,
          (t - 1) // {N} AS num_blocks, ((t - 1) // {N}) * {N} AS num_tokens, '<u4' AS dtype
        FROM (SELECT CAST(sum(len(ids)) AS BIGINT) AS t FROM token_docs)""",
    ),
    "pack_check": _with(
        TOKENS,
        f"""total AS (SELECT CAST(sum(len(ids)) AS BIGINT) AS t FROM token_docs),
        stored AS (SELECT (t - 1) // {N} AS blocks, ((t - 1) // {N}) * {N + 1} AS ids FROM total),
        cases AS (
          SELECT 'sound' AS metadata, {N} AS n, blocks, blocks * {N} AS tokens, ids FROM stored
          UNION ALL SELECT 'short', {N}, blocks - 1, blocks * {N}, ids FROM stored
          UNION ALL SELECT 'wrong_tokens', {N}, blocks, blocks * {N} + 1, ids FROM stored
          UNION ALL SELECT 'no_length', 0, blocks, blocks * {N}, ids FROM stored)""",
        select="""SELECT 'invalid pack metadata values' AS problem, metadata FROM cases
          WHERE n <= 0 OR blocks <= 0
        UNION ALL SELECT 'invalid token count in pack metadata', metadata FROM cases
          WHERE tokens <> blocks * n
        UNION ALL SELECT 'packed data does not match metadata', metadata FROM cases
          WHERE blocks * (n + 1) * 4 <> ids * 4""",
    ),
    "packed_read": _with(
        TOKENS, BLOCKS, select="SELECT block_id, array_to_string(ids, ' ') AS ids FROM blocks"
    ),
    "packed_file": _with(
        TOKENS,
        select=f"""SELECT 'train-' || printf('%06d', f + 1) || '.bin' AS object_key,
          n * {(N + 1) * 4} AS size_bytes, n AS record_count, n * {(N + 1) * 4} AS stored_size_bytes
        FROM (SELECT b // 1000 AS f, count(*) AS n
          FROM (SELECT unnest(range((t - 1) // {N})) AS b
            FROM (SELECT CAST(sum(len(ids)) AS BIGINT) AS t FROM token_docs)) GROUP BY 1)""",
    ),
    "shifted_examples": _with(
        TOKENS,
        BLOCKS,
        select=f"""SELECT block_id, array_to_string(ids[1:{N}], ' ') AS inputs,
          array_to_string(ids[2:{N + 1}], ' ') AS targets FROM blocks""",
    ),
    "sequential_batches": _with(
        TOKENS,
        BLOCKS,
        select="""SELECT block_id // 2 AS batch_id, CAST(count(*) AS INTEGER) AS examples,
          string_agg(array_to_string(ids, ' '), ' ' ORDER BY block_id) AS ids
        FROM blocks GROUP BY 1""",
    ),
    "weighted_perplexity": f"""WITH counts AS (
          SELECT word, count(*) AS n FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word),
        size AS (SELECT sum(n) AS total, count(*) AS words FROM counts),
        heldout AS (
          SELECT batch_id, word, count(*) AS times FROM (
            SELECT item_id // 2 AS batch_id, unnest({WORDS}) AS word FROM benchmark) GROUP BY 1, 2),
        scores AS (
          SELECT batch_id, sum(times) AS items,
            sum(times * -ln((coalesce(n, 0) + 1) / (total + words + 1))) / sum(times) AS loss
          FROM heldout LEFT JOIN counts USING (word), size GROUP BY batch_id)
        SELECT round(loss, 6) AS loss, round(exp(loss), 3) AS perplexity
        FROM (SELECT sum(loss * items) / sum(items) AS loss FROM scores)""",
    "incremental_ingest": f"""SELECT source AS source_id, count(*) AS records,
          CAST(sum(strlen({PAYLOAD}) + 1) AS BIGINT) AS bytes, max(doc_id) AS last_pos, true AS ids_unique
        FROM documents GROUP BY source""",
    "lifecycle_stream": _with(
        HISTORY,
        ALLOWED,
        """numbered AS (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS k FROM history),
        judged(id, seq, k, from_status, to_status, accepted) AS (
          SELECT id, seq, k, 'PENDING', status,
            status = 'PENDING' OR ('PENDING', status) IN (SELECT (a, b) FROM allowed)
          FROM numbered WHERE k = 1
          UNION ALL
          SELECT n.id, n.seq, n.k,
            CASE WHEN j.accepted THEN j.to_status ELSE j.from_status END, n.status,
            CASE WHEN j.accepted THEN j.to_status ELSE j.from_status END = n.status
              OR (CASE WHEN j.accepted THEN j.to_status ELSE j.from_status END, n.status)
                IN (SELECT (a, b) FROM allowed)
          FROM judged j JOIN numbered n ON n.id = j.id AND n.k = j.k + 1)""",
        select="SELECT id, seq, from_status, to_status, accepted FROM judged",
    ),
}
ORACLES["exactly_once_commit"] = ORACLES["incremental_ingest"]
ORACLES["graceful_pause"] = (
    f"SELECT *, true AS paused_first, false AS paused_again FROM ({ORACLES['incremental_ingest']})"
)
