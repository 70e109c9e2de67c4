"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from vouch.llm import urls
from vouch.llm.queries import URL_RULES


def _url_filters() -> str:
    """Rules as a CASE, and the iterations of both ranks as a chain of common table expressions."""
    fits = [
        (
            f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')",
            r.text,
            "allow" if r.allow else "block",
        )
        for r in sorted(URL_RULES, key=lambda r: -len(r.text))
    ]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{t}'" for f, t, _ in fits) + " END"
    ruled = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits) + " END"
    split = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    link = urls.LINK.replace("'", "''")
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    steps = [
        f"""s{k} AS (SELECT side, host, sum(score) AS score FROM (
          SELECT e.side, e.dst AS host, {urls.DAMPING} * s.score * e.share AS score FROM s{k - 1} s JOIN shares e ON s.side = e.side AND s.host = e.src
          UNION ALL SELECT side, host, (1 - {urls.DAMPING}) * score FROM s0) GROUP BY side, host)"""
        for k in range(1, urls.ITERATIONS + 1)
    ]
    side = lambda s: f"sum(CASE WHEN side = '{s}' THEN score ELSE 0 END)"
    least = f"{urls.THRESHOLD * (1 + 10.0**-urls.DIGITS)!r}::DOUBLE"
    return f"""WITH split AS (
      SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '{split}', 1), {lower}) AS host,
        regexp_extract(coalesce(url, ''), '{split}', 2) AS path FROM pages),
    marked AS (SELECT page_id, html, host, path, {rule} AS rule, {ruled} AS ruled FROM split),
    found AS (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '{link}', 1)), {lower}) AS dst FROM split WHERE host <> ''),
    names AS (SELECT DISTINCT host FROM (SELECT host FROM split WHERE host <> '' UNION ALL SELECT dst FROM found WHERE src <> dst)),
    labels AS (SELECT string_split(host, '.') AS l FROM names),
    parts AS (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM labels),
    child AS (SELECT DISTINCT array_to_string(l[i:], '.') AS src, array_to_string(l[i + 1:], '.') AS dst FROM parts),
    edges AS (SELECT src, dst, sum(w) AS w FROM (
      SELECT src, dst, count(*) AS w FROM found WHERE src <> dst GROUP BY src, dst
      UNION ALL SELECT src, dst, 1 FROM child UNION ALL SELECT dst, src, 1 FROM child) GROUP BY src, dst),
    sides AS (SELECT 'trust' AS side, src, dst, w FROM edges UNION ALL SELECT 'distrust', dst, src, w FROM edges),
    shares AS (SELECT side, src, dst, w / sum(w) OVER (PARTITION BY side, src) AS share FROM sides),
    seeds AS (SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS side, host, count(*) AS n
      FROM marked WHERE ruled IS NOT NULL AND host <> '' GROUP BY ALL),
    s0 AS (SELECT side, host, n / sum(n) OVER (PARTITION BY side) AS score FROM seeds),
    {", ".join(steps)},
    scores AS (SELECT host, {side("trust")} AS trust, {side("distrust")} AS distrust FROM s{urls.ITERATIONS} GROUP BY host)
    SELECT page_id, m.host, path, rule,
      coalesce(ruled, CASE WHEN coalesce(distrust, 0) > {least} * coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict
    FROM marked m LEFT JOIN scores s ON m.host = s.host"""


_CHATS = """WITH users AS (SELECT conv_id, turn, min(text) AS text FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
    replies AS (SELECT conv_id, turn, min(text) AS text FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
    rows_ AS (SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.turn, a.turn - 1) AS place, coalesce(u.turn, a.turn) AS turn,
        u.conv_id IS NOT NULL AS called, a.conv_id IS NOT NULL AS answered, u.text AS text, a.text AS content,
        p.conv_id IS NOT NULL AS follows
      FROM users u FULL JOIN replies a ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn
      LEFT JOIN users p ON u.conv_id = p.conv_id AND u.turn - 2 = p.turn)
    SELECT conv_id, conv_id || ':' || place AS call_id, turn, CASE WHEN called THEN 0 END AS level,
      CASE WHEN NOT called THEN 'orphan' WHEN answered THEN 'linked' ELSE 'unanswered' END AS status,
      NOT called OR length(text) > 0 AS valid,
      CASE WHEN called AND length(text) = 0 THEN '/text: too short' ELSE '' END AS faults,
      CASE WHEN called THEN
        '{"after":[' || CASE WHEN follows THEN '"' || conv_id || ':' || (turn - 2) || '"' ELSE '' END || '],"arguments":{"text":' || to_json(text)
        || ',"turn":' || turn || '},"id":"' || conv_id || ':' || place || '","name":"reply","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}'
      ELSE '{"id":"' || conv_id || ':' || place || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' END AS json
    FROM rows_
    UNION ALL SELECT conv_id, NULL, turn, NULL, 'message', true, '',
      '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || '}'
    FROM conversations WHERE coalesce(role NOT IN ('user', 'assistant'), true) OR conv_id IS NULL OR turn IS NULL"""


def _prefix_trie() -> str:
    """Keys are MD5 of a prefix's turns; what a node gives goes along the path of its smallest member."""
    bits = "list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte))"
    letters = "list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    crc = f"xor(list_reduce({letters}, lambda crc, byte: {bits}, 4294967295::BIGINT), 4294967295)"
    turn = "md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {turn}) AS pos,
        {turn} AS digest, strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
    plan AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base FROM turns GROUP BY conv_id),
    cuts AS (SELECT p.*, {crc} % 9 AS h FROM plan p),
    sized AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM cuts c LEFT JOIN plan b ON c.base = b.conv_id),
    rebuilt AS (SELECT s.conv_id, 0 AS depth, '' AS digest, 0 AS bytes FROM sized s
      UNION ALL SELECT s.conv_id, t.pos, t.digest, t.bytes FROM sized s JOIN turns t ON s.base = t.conv_id AND t.pos <= s.h
      UNION ALL SELECT s.conv_id, s.taken + t.pos - s.h, t.digest, t.bytes FROM sized s JOIN turns t ON s.conv_id = t.conv_id AND t.pos > s.h),
    keyed AS (SELECT conv_id, depth, bytes, md5(string_agg(digest, '' ORDER BY depth) OVER w) || ':' || depth AS key, depth = max(depth) OVER (PARTITION BY conv_id) AS last
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
    paths AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM keyed),
    members AS (SELECT key, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
      sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256 FROM paths GROUP BY key),
    kids AS (SELECT parent AS key, count(*) AS n_children FROM members WHERE parent IS NOT NULL GROUP BY parent),
    nodes AS (SELECT m.*, coalesce(k.n_children, 0) AS n_children FROM members m LEFT JOIN kids k ON m.key = k.key),
    sums AS (SELECT p.key, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
      FROM nodes n JOIN paths p ON n.conv_id = p.conv_id AND p.depth <= n.depth GROUP BY p.key)
    SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON n.key = s.key LEFT JOIN nodes u ON n.parent = u.key"""


#: Base 32 of a SHA-1: five hex digits are four letters.
_WARC = """WITH hashed AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
    dealt AS (SELECT page_id, strlen(html) AS payload_bytes,
        list_transform(range(0, 40, 5), lambda i: ('0x' || substr(hex, i::INT + 1, 5))::INT) AS fives,
        row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place, max(page_id) OVER (PARTITION BY html) AS top
      FROM hashed)
    SELECT page_id, payload_bytes,
      array_to_string(list_transform(fives, lambda f: array_to_string(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((f >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
      CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN top END AS refers_to FROM dealt"""


ORACLES: dict[str, str] = {"op2_url_filters": _url_filters(), "op10_chat_formatting": _CHATS, "op11_conversation_prefix_trie": _prefix_trie(), "op12_warc": _WARC}
