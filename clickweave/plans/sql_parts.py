"""Building blocks of the check SQL (DuckDB dialect, tables registered as views)."""

from __future__ import annotations

# Limits used with the given events, wide enough for the duration cap to matter there.
INACTIVITY_MINUTES = 1440
MAX_MINUTES = 4320
GAP_MS = INACTIVITY_MINUTES * 60_000
CAP_MS = MAX_MINUTES * 60_000

CLICKS = """
clicks AS (
    SELECT CAST(user_id AS VARCHAR) AS uuid, event_id, event_type AS page_name,
           (epoch_us(ts) // 1000) AS ms
    FROM events
)"""


def islands(gap_ms: int = GAP_MS, source: str = "clicks", extra: str = "false") -> str:
    """CTEs up to ``isl(uuid, event_id, page_name, ms, gap, island, island_start)``."""
    return f"""
gaps AS (
    SELECT *, ms - lag(ms) OVER (PARTITION BY uuid ORDER BY ms, event_id) AS gap FROM {source}
),
opens AS (
    SELECT *, CASE WHEN gap IS NULL OR gap > {gap_ms}
                     OR (gap > 0 AND bool_or({extra}) OVER (PARTITION BY uuid, ms))
              THEN 1 ELSE 0 END AS opens
    FROM gaps
),
numbered AS (
    SELECT *, CAST(sum(opens) OVER (PARTITION BY uuid ORDER BY ms, event_id
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island
    FROM opens
),
isl AS (
    SELECT *, min(ms) OVER (PARTITION BY uuid, island) AS island_start FROM numbered
)"""


def bins(cap_ms: int = CAP_MS) -> str:
    """CTE ``sess(uuid, event_id, page_name, ms, session_id, s, e)``, policy bin."""
    return f"""
binned AS (
    SELECT *, uuid || '_session_' || island || '_' || ((ms - island_start) // {cap_ms}) AS session_id
    FROM isl
),
sess AS (
    SELECT *, min(ms) OVER (PARTITION BY uuid, session_id) AS s,
              max(ms) OVER (PARTITION BY uuid, session_id) AS e
    FROM binned
)"""


def greedy(cap_ms: int = CAP_MS) -> str:
    """CTE ``sess(...)``, policy greedy: a recursive chain of session starts per island."""
    return f"""
chain AS (
    SELECT DISTINCT uuid, island, island_start AS start FROM isl
    UNION ALL
    SELECT c.uuid, c.island, min(i.ms)
    FROM chain c JOIN isl i ON i.uuid = c.uuid AND i.island = c.island AND i.ms > c.start + {cap_ms}
    GROUP BY c.uuid, c.island
),
starts AS (
    SELECT uuid, start, row_number() OVER (PARTITION BY uuid ORDER BY start) AS n FROM chain
),
placed AS (
    SELECT isl.*, starts.start AS s, starts.n
    FROM isl ASOF JOIN starts ON isl.uuid = starts.uuid AND isl.ms >= starts.start
),
sess AS (
    SELECT *, uuid || '_session_' || n AS session_id,
           max(ms) OVER (PARTITION BY uuid, s) AS e
    FROM placed
)"""


BIN_SESSIONS = f"WITH {CLICKS}, {islands()}, {bins()}"
GREEDY_SESSIONS = f"WITH RECURSIVE {CLICKS}, {islands()}, {greedy()}"

EVENT_COLUMNS = """
    uuid, event_id, session_id, s AS session_start_time_ms, e AS session_end_time_ms,
    (e - s) / 1000.0::DOUBLE AS session_duration_seconds"""

ROLLUP_COLUMNS = """
    uuid, session_id, min(ms) AS session_start_time_ms, max(ms) AS session_end_time_ms,
    count(*) AS event_count, (max(ms) - min(ms)) / 1000.0::DOUBLE AS session_duration_seconds"""

# One row per session with its start date, policy bin.
ROLLUP = f"""{BIN_SESSIONS},
rollup AS (
    SELECT {ROLLUP_COLUMNS}, strftime(epoch_ms(min(ms)), '%Y-%m-%d') AS session_date
    FROM sess GROUP BY uuid, session_id
)"""


def bucket(text: str, buckets: int = 100) -> str:
    """SQL for the user bucket: Spark's Murmur3 (seed 42) of an ASCII string.

    Whole four-byte words first, then each remaining byte as a word of its own.
    """
    limit = 4294967296

    def times(value: str, factor: int) -> str:
        return f"(({value}) * {factor}::UBIGINT % {limit}::UBIGINT)"

    def rotate(value: str, bits: int) -> str:
        return f"({times(value, 1 << bits)} + ({value}) // {1 << (32 - bits)}::UBIGINT)"

    def byte(position: str) -> str:
        return f"ascii({text}[{position}])::UBIGINT"

    word = " + ".join(f"{byte(f'4 * i + {k + 1}')} * {256 ** k}::UBIGINT" for k in range(4))
    words = (
        f"list_concat([42::UBIGINT], list_transform(range(length({text}) // 4), lambda i: {word}),"
        f" list_transform(range(length({text}) // 4 * 4, length({text})), lambda i: {byte('i + 1')}))"
    )
    mixed = times(rotate(times("w", 3432918353), 15), 461845907)
    step = f"({times(rotate(f'xor(h, {mixed})', 13), 5)} + 3864292196::UBIGINT) % {limit}::UBIGINT"
    hashed = f"list_reduce({words}, lambda h, w: {step})"
    # Final avalanche, each step as a one-element transform so that its input is named once.
    hashed = f"xor({hashed}, length({text})::UBIGINT)"
    for shift, factor in ((16, 2246822507), (13, 3266489909)):
        hashed = f"list_transform([{hashed}], lambda x: {times(f'xor(x, x >> {shift})', factor)})[1]"
    hashed = f"list_transform([{hashed}], lambda x: xor(x, x >> 16))[1]"
    signed = f"list_transform([{hashed}], lambda x: least(x, {limit}::UBIGINT - x))[1]"
    return f"CAST(({signed}) % {buckets} AS INTEGER)"
