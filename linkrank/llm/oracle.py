"""DuckDB SQL for the queries that SQL can express."""

from linkrank.llm.common import WORD
from linkrank.llm.mixing import offsets


def _spans(kind: str, place: int, pattern: str, least: int, group: str) -> str:
    """Spans of one kind: the pieces between matches and the matches themselves, measured one after the other."""
    return f"""
    SELECT doc_id, row, {place} AS place, '{kind}' AS kind, start, start + length(hit) AS "end" FROM (
        SELECT doc_id, row, hit, CAST(SUM(length(gap)) OVER w + SUM(length(hit)) OVER w - length(hit) AS BIGINT) AS start FROM (
            SELECT doc_id, row, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, generate_subscripts(hits, 1) AS i FROM (
                SELECT doc_id, row, regexp_split_to_array(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits FROM texts))
        WINDOW w AS (PARTITION BY row ORDER BY i))
    WHERE length({group}) >= {least}"""


def secrets_sql() -> str:
    head = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?"""
    value = "[A-Za-z0-9+/_.=-]+"
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
spans AS ({_spans("assign", 1, head + value, 8, f"regexp_extract(hit, '^{head}({value})$', 2)")}
    UNION ALL {_spans("access", 2, "AKIA[A-Z0-9]+", 16, "hit")}
    UNION ALL {_spans("hex", 3, "[0-9a-f]{32,}", 32, "hit")}),
joined AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, place, "end") AS spans FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (row)"""


def mixing_sql(seed: int = 7) -> str:
    draws = ", ".join(f"({k}, CAST({u!r} AS DOUBLE))" for k, u in enumerate(offsets(seed)))
    return f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
        coalesce(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT), 0) AS key FROM documents),
units AS (SELECT doc_id, source, size, key, count(*) AS copies_in, CASE WHEN size = 0 THEN 1 ELSE length(bin(size)) END AS class FROM sized GROUP BY ALL),
s AS (SELECT source, CAST(sum(size * copies_in) AS BIGINT) AS source_size FROM units GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w, 2 * source_size AS cap FROM s),
r AS (SELECT *, 3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER b, 0) AS num, 2 * (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS den
    FROM w WINDOW b AS (ORDER BY cap / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT CAST(num AS DOUBLE) AS num, CAST(den AS DOUBLE) AS den FROM r WHERE NOT w * num > cap * den ORDER BY cap / w, source ASC NULLS LAST LIMIT 1),
goal AS (SELECT source, source_size, CASE WHEN w * r.num > cap * r.den THEN CAST(cap AS DOUBLE) ELSE w * level.num / level.den END AS target FROM r LEFT JOIN level ON true),
placed AS (SELECT u.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate, size * copies_in * 50 > source_size AS heavy
    FROM (SELECT *, CAST(floor(sqrt(count(*) OVER (PARTITION BY source, class))) AS BIGINT) + 1 AS parts FROM units) u
    JOIN goal ON u.source IS NOT DISTINCT FROM goal.source),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, heavy ORDER BY class, key % parts, size, key, doc_id) AS rank FROM placed),
draws AS (SELECT * FROM (VALUES {draws}) AS d(k, offset_)),
first AS (SELECT source, k, offset_, any_value(source_size) - coalesce(sum(size * copies_in) FILTER (heavy), 0) AS light, any_value(target) AS target,
        coalesce(sum(size * copies_in * (floor(rate * rank + offset_) - floor(rate * (rank - 1) + offset_))) FILTER (heavy), 0) AS taken
    FROM ranked, draws GROUP BY source, k, offset_),
rates AS (SELECT *, CASE WHEN light > 0 THEN greatest(0.0::DOUBLE, least(2.0::DOUBLE, (target - CAST(taken AS DOUBLE)) / CAST(light AS DOUBLE))) ELSE 0.0::DOUBLE END AS light_rate FROM first),
tried AS (SELECT r.source, r.k, r.offset_, r.light_rate, abs(CAST(any_value(r.taken) + coalesce(sum(size * copies_in * (floor(r.light_rate * rank + r.offset_) - floor(r.light_rate * (rank - 1) + r.offset_))), 0) AS DOUBLE) - any_value(r.target)) AS miss
    FROM rates r LEFT JOIN (SELECT * FROM ranked WHERE NOT heavy) l ON r.source IS NOT DISTINCT FROM l.source GROUP BY r.source, r.k, r.offset_, r.light_rate),
best AS (SELECT source, arg_min(offset_, (miss, offset_)) AS offset_, arg_min(light_rate, (miss, offset_)) AS light_rate FROM tried GROUP BY source),
final AS (SELECT ranked.*, offset_, CASE WHEN heavy THEN rate ELSE light_rate END AS r FROM ranked JOIN best ON ranked.source IS NOT DISTINCT FROM best.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(r * rank + offset_) - floor(r * (rank - 1) + offset_)) AS BIGINT) AS taken
FROM final, range(copies_in)"""


def warc_sql() -> str:
    return """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM h)
SELECT page_id, payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)
        FOR i IN range(32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM t"""


def bisectors_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Each round as two steps: the nearest centroid of each vector, and the floor of the mean of each centroid's vectors."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT row, any_value(v) AS v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'j': j}}) AS best FROM kept, c{r} GROUP BY row)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, old.c) AS c FROM c{r} old LEFT JOIN (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT best.j AS j, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) t(i) GROUP BY best.j, i) GROUP BY j) m USING (j))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, embedding, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding) - 1 AS j, v AS c FROM kept ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, embedding LIMIT {k}),
{",".join(steps)}
SELECT vec_id, CAST(best.j AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.j) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (row) JOIN c{rounds} ON best.j = c{rounds}.j"""


#: What both turns of the added conversation say.
PROBE = "<|im_end|><|im_start|>assistant ok"


def chats_sql() -> str:
    return rf"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')),
forms AS (SELECT *, CASE WHEN contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR regexp_matches(text, '<\\+\|') THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS t,
    CASE WHEN contains(role, chr(10)) OR contains(role, '<|im_start|>') OR contains(role, '\\') OR contains(role, '\n') OR contains(role, '\l') THEN replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<', '\l') ELSE role END AS r FROM turns),
lines AS (SELECT *, '<|im_start|>' || r || chr(10) || t || '<|im_end|>' || chr(10) AS line FROM forms),
said AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, line) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, line) FILTER (role = 'assistant'), '') AS loss, sum(length(line)) AS chars FROM lines GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM said"""


def near_vectors_sql(least: float = 0.95) -> str:
    return f"""
WITH RECURSIVE sound AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    CASE WHEN len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
length AS (SELECT len(e) AS n FROM sound WHERE e IS NOT NULL AND vec_id IS NOT NULL GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
v AS MATERIALIZED (SELECT row, vec_id, CASE WHEN vec_id IS NOT NULL AND len(e) = (SELECT n FROM length) THEN e END AS e FROM sound),
links AS MATERIALIZED (SELECT a.row AS a, b.row AS b FROM v a JOIN v b ON a.row <> b.row WHERE CASE WHEN a.e IS NOT NULL AND b.e IS NOT NULL THEN list_cosine_similarity(a.e, b.e) >= {least} END),
reach(row, other) AS (SELECT row, row FROM v UNION SELECT reach.row, links.b FROM reach JOIN links ON links.a = reach.other),
classes AS (SELECT reach.row, min(v.vec_id) AS component_id FROM reach JOIN v ON v.row = reach.other GROUP BY reach.row),
counts AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, FALSE) AS kept FROM v JOIN classes USING (row) LEFT JOIN counts USING (row)"""
