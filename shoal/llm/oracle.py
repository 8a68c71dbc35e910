"""DuckDB SQL of the queries that SQL can express."""

_NEAR = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(ws) - 3),
           lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) END AS s
  FROM w),
sh AS (SELECT doc_id, unnest(s) AS x FROM sets),
size AS (SELECT doc_id, len(s) AS n FROM sets),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY 1, 2),
link AS (SELECT a, b FROM both_in i JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * i.n >= 80 * (x.n + y.n - i.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM size UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT r.doc_id, CAST(any_value(z.n) AS BIGINT) AS n_shingles, min(r.other) AS component_id,
       r.doc_id = min(r.other) AS kept
FROM reach r JOIN size z ON z.doc_id = r.doc_id GROUP BY r.doc_id
"""



def _step(role: str, edit: str, cost: str, line: str | None = None) -> str:
    """SQL of the best repair that ends in ``role`` after one more edit."""
    kept = f"list_append({role}.t, {line})" if line else f"{role}.t"
    return f"{{'c': {role}.c + {cost}, 'a': {role}.a || '{edit}', 't': {kept}}}"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


_NOT_YET = "{'c': 1000000000000, 'a': '', 't': []::VARCHAR[]}"
_OPEN = "fault IN (0, 3)"


def _edited(to: str, word: str, initial: str, sources: list[str]) -> list[str]:
    """Keeps and changes of a turn that end in the role of ``word``."""
    more = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    options = [f"CASE WHEN {_OPEN} AND initial = '{initial}' THEN {_step(s, 'K', more, 'line')} ELSE {_NOT_YET} END" for s in sources]
    if word:
        options += [f"CASE WHEN {_OPEN} THEN {_step(s, 'R', f'3 + {more}', f"'{word}:' || text")} ELSE {_NOT_YET} END" for s in sources]
    return [_step(to, "D", "4"), *options]


_REPAIR = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
marked AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) % 256 AS BIGINT) + 1])), 4294967295) % 20 AS kind FROM given, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS n FROM marked WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, n) AS r,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, n) AS again FROM hurt),
turns AS (
  SELECT conv_id, turn, r, text, left(role, 1) AS initial, role || ':' || text AS line,
    CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 1 WHEN again > 1 THEN 2
      WHEN NOT regexp_matches(text, '[.!?][ 	-]*\z') THEN 3 ELSE 0 END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY r) AS before FROM placed),
walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS r, {{'c': CAST(0 AS BIGINT), 'a': '', 't': []::VARCHAR[]}} AS e, {_NOT_YET} AS s, {_NOT_YET} AS u, {_NOT_YET} AS v
  FROM conversations
  UNION ALL
  SELECT conv_id, r, {_step('e', 'D', '4')} AS e, {_least(*_edited('s', '', 's', ['e']))} AS s,
    {_least(*_edited('u1', 'user', 'u', ['e', 's', 'v1']))} AS u, {_least(*_edited('v1', 'assistant', 'a', ['u1']))} AS v
  FROM (SELECT *, {_least('v', _step('u1', 'I', '3', "'assistant:'"))} AS v1
        FROM (SELECT w.conv_id, p.r, p.text, p.initial, p.line, p.fault, w.e, w.s, w.u, w.v,
                {_least('w.u', *[_step(f'w.{x}', 'I', '3', "'user:'") for x in 'esv'])} AS u1
              FROM walk w JOIN turns p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.r = w.r + 1) x) y),
ends AS (
  SELECT conv_id, r, {_least('e', 'v', _step('u', 'I', '3', "'assistant:'"),
                             f"{{'c': s.c + 6, 'a': s.a || 'II', 't': list_concat(s.t, ['user:', 'assistant:'])}}")} AS best FROM walk),
counts AS (
  SELECT conv_id, max(r) AS r, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
SELECT w.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ends w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.r = coalesce(c.r, 0)
"""

ORACLE = {"op1_near_dedup": _NEAR, "op13_conversations": _REPAIR}
