"""SQL for the rows of the operators on conversations."""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII string, bit by bit."""
    bits = (
        f"flatten(list_transform(string_split({text}, ''), "
        "lambda c: list_transform(range(8), lambda k: ((ascii(c) >> k::INT) & 1)::BIGINT)))"
    )
    step = "xor(crc >> 1, CASE WHEN xor(crc, bit) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce({bits}, lambda crc, bit: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _edit(state: str, cost: str, letter: str) -> str:
    """A state (8 digits of cost, then the letters so far) after one more edit; NULL where there is none."""
    return f"lpad(({state}[1:8]::INT + {cost})::VARCHAR, 8, '0') || {state}[9:] || '{letter}'"


def _step() -> str:
    keep, rerole, any_user = "more", "more + 3", "least(n.s0, n.s1, n.s3)"
    must = "coalesce(fault IN ('blank', 'duplicate'), false)"
    return f"""
  SELECT conv_id, place, d0 AS s0, d1 AS s1, i2 AS s2, least(d3, {_edit("i2", "3", "I")}) AS s3
  FROM (SELECT *, {_edit("s0", "4", "D")} AS d0,
          least({_edit("s1", "4", "D")}, CASE WHEN NOT must AND letter = 's' THEN {_edit("s0", keep, "K")} END) AS d1,
          least({_edit("s2", "4", "D")}, CASE WHEN NOT must AND letter = 'u' THEN {_edit("before", keep, "K")} END,
                CASE WHEN NOT must THEN {_edit("before", rerole, "R")} END) AS d2,
          least({_edit("s3", "4", "D")}, CASE WHEN NOT must AND letter = 'a' THEN {_edit("s2", keep, "K")} END,
                CASE WHEN NOT must THEN {_edit("s2", rerole, "R")} END) AS d3,
          least(d2, {_edit("d0", "3", "I")}, {_edit("d1", "3", "I")}, {_edit("d3", "3", "I")}) AS i2
        FROM (SELECT n.*  EXCLUDE (place), f.place, {any_user} AS before, letter, {must} AS must,
                     CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more
              FROM n JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.place = n.place + 1))"""


REPAIR = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM given WHERE kind <> 0 UNION ALL SELECT conv_id, turn, role, text FROM given WHERE kind = 3),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, role[1:1] AS letter
  FROM damaged),
f AS (
  SELECT *, CASE WHEN rtrim(text, {_BLANKS}) = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN right(rtrim(text, {_BLANKS}), 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         letter || lead(letter) OVER (PARTITION BY conv_id ORDER BY place) AS pair
  FROM ordered),
n AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS place, '00000000' AS s0, NULL::VARCHAR AS s1, '00000003I' AS s2, '00000006II' AS s3
  FROM given
  UNION ALL {_step()}),
best AS (SELECT conv_id, arg_max(least(s0, s3), place) AS found FROM n GROUP BY conv_id),
letters AS (
  SELECT conv_id, unnest(string_split(found[9:], '')) AS edit, unnest(range(1, len(found) - 7)) AS j FROM best
  WHERE len(found) > 8),
placed AS (
  SELECT *, sum((edit <> 'I')::INT) OVER w AS place, sum((edit <> 'D')::INT) OVER w AS k
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
turns AS (
  SELECT p.conv_id, j, edit, k, CASE edit WHEN 'I' THEN '' ELSE text END AS text, role,
         max((k = 1 AND edit = 'K' AND letter = 's')::INT) OVER (PARTITION BY p.conv_id) AS opened
  FROM placed p LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place WHERE edit <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || text, chr(10) ORDER BY j) AS whole
  FROM turns GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, found[1:8]::BIGINT AS cost,
       found[9:] AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
            LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id
"""

TRIE = rf"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS first, {crc32_sql("conv_id::VARCHAR")} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (
  SELECT c.conv_id, 0 AS part, place, role, text FROM c JOIN o ON o.conv_id = first AND place < h
  UNION ALL SELECT o.conv_id, 1, place, role, text FROM o JOIN c USING (conv_id) WHERE place >= h),
m AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM (
    SELECT conv_id, 0 AS depth, '' AS path, 0 AS words FROM c
    UNION ALL
    SELECT conv_id, row_number() OVER w, string_agg(md5(role) || md5(text), '') OVER w,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
    FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING))),
n AS (
  SELECT path, left(path, len(path) - 64) AS parent, min(conv_id) AS conv_id, max(depth) AS depth, count(*) AS n_convs,
         max(words) AS words, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM m GROUP BY path),
k AS (SELECT parent AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
t AS (SELECT m.path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n.words) AS saved_tokens
      FROM n LEFT JOIN k USING (path) JOIN m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.path)
SELECT n.conv_id, n.depth::BIGINT AS depth, CASE WHEN n.depth > 0 THEN p.conv_id END AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       sha256(n.ids) AS ends_sha256
FROM n JOIN t USING (path) LEFT JOIN k USING (path) LEFT JOIN n p ON p.path = n.parent
"""
