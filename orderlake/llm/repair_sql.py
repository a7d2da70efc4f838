"""DuckDB SQL of ``op13_conversation_repair``: the damage, the faults and the
cheapest repair as a recursion over the turns that keeps, for each last role,
the least (cost, audit) with the text it gives."""

from __future__ import annotations

STATES = ("e", "s", "u", "a")  # nothing yet, system, user, assistant


def _way(state: str, cost: str, letter: str, line: str) -> str:
    """One edit more than ``state``; null where that is null."""
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', "
            f"'t': {state}.t || {line}}} END")


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))"


def _insert(state: str, role: str) -> str:
    return _way(state, "5", "I", f"chr(10) || '{role}:'")


_DELETE = {x: _way(x, "2", "D", "''") for x in STATES}


def _emit(state: str, role: str) -> list[str]:
    """A kept or reroled turn that makes the last role ``role``."""
    extra = "(CASE WHEN truncated THEN 5 ELSE 0 END)"
    keep = _way(state, extra, "K", "chr(10) || role || ':' || text")
    rerole = _way(state, f"1 + {extra}", "R", f"chr(10) || '{role}:' || text")
    ways = [f"CASE WHEN NOT must_go AND left(role, 1) = '{role[0]}' THEN {keep} END"]
    return ways if role == "system" else [*ways, f"CASE WHEN NOT must_go THEN {rerole} END"]


# inserted turns before the next one: two steps reach every role from every other
_ONE = (_least("u", *(_insert(x, "user") for x in ("e", "s", "a"))), _least("a", _insert("u", "assistant")))
_TWO = (_least("u", _insert("a", "user")), _least("a", _insert("u", "assistant")))
_NEXT = (_DELETE["e"], _least(_DELETE["s"], *_emit("e", "system")),
         _least(_DELETE["u"], *(w for x in ("e", "s", "a") for w in _emit(x, "user"))),
         _least(_DELETE["a"], *_emit("u", "assistant")))


def _inserted(source: str) -> str:
    one = f"SELECT * REPLACE ({_ONE[0]} AS u, {_ONE[1]} AS a) FROM ({source})"
    return f"SELECT * REPLACE ({_TWO[0]} AS u, {_TWO[1]} AS a) FROM ({one})"


OP13_SQL = rf"""
WITH RECURSIVE
crc_table AS (SELECT [list_reduce([i] || [0::BIGINT FOR _ IN range(8)], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))
                      FOR i IN range(256)] AS t),
src AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, turn, coalesce(role, ' ') AS role,
         coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
fates AS (
  SELECT s.*, xor(4294967295, list_reduce([4294967295] || [CAST(ord(x) AS BIGINT) FOR x IN string_split(k, '')],
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS fate FROM src s, crc_table),
damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fates, range(2) c(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS i
  FROM damaged),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS unended,
         left(lag(role) OVER (PARTITION BY conv ORDER BY i), 1) || left(role, 1) AS pair FROM turns),
faulty AS (
  SELECT conv, i, turn, role, text, blank, again AND NOT blank AS duplicate, unended AND NOT again AND NOT blank AS truncated,
         blank OR again AS must_go, coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal FROM seen),
facts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (illegal) AS illegal, count(*) AS n FROM faulty GROUP BY conv),
ways AS (
  SELECT conv, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS e, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS s,
         CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS u, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS a
  FROM facts
  UNION ALL
  SELECT conv, i, {", ".join(_NEXT)} FROM (
    SELECT w.conv, f.i, w.e, w.s, w.u, w.a, f.role, f.text, f.must_go, f.truncated
    FROM ({_inserted("SELECT * FROM ways")}) w JOIN faulty f ON f.conv = w.conv AND f.i = w.i + 1)),
best AS (
  SELECT conv, {_least("e", "a")} AS v FROM ({_inserted("SELECT ways.* FROM ways JOIN facts ON ways.conv = facts.conv AND i = n")}))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.c, 0) AS cost,
       coalesce(v.a, '') AS audit, sha256(coalesce(substr(v.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM src) c LEFT JOIN facts USING (conv) LEFT JOIN best USING (conv)
"""
