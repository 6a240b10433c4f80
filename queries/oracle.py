"""The same results as plain SQL over the test tables, in DuckDB's dialect."""

from __future__ import annotations

from queries import graphs

D = "0.85::DOUBLE"
TRIM = r"trim(value, E' \t\n\r\f\x0b')"


def graph(name: str, dedupe: bool = True) -> str:
    """CTEs ``edges(src, dst, copies)``, ``deg(id, out_degree)`` and ``links``."""
    copies = "1::BIGINT" if dedupe else "count(*)::BIGINT"
    return f"""
    raw AS MATERIALIZED ({graphs.SQL[name]}),
    edges AS MATERIALIZED (SELECT src, dst, {copies} AS copies FROM raw GROUP BY src, dst),
    ids AS (SELECT src AS id FROM raw UNION SELECT dst FROM raw),
    deg AS MATERIALIZED (
        SELECT id, coalesce(sum(copies), 0)::BIGINT AS out_degree
        FROM ids LEFT JOIN edges ON src = id GROUP BY id),
    total AS (SELECT count(*)::DOUBLE AS n FROM deg),
    links AS MATERIALIZED (SELECT src, dst, copies, out_degree FROM edges JOIN deg ON src = id)"""


def ranks(iterations: int) -> str:
    """CTE ``ranks(iteration, id, out_degree, rank)`` from 0 to the given number of iterations."""
    return f"""
    ranks(iteration, id, out_degree, rank) AS (
        SELECT 0::BIGINT, id, out_degree, 1.0::DOUBLE / n FROM deg, total
        UNION ALL
        SELECT p.iteration + 1, p.id, p.out_degree,
            (1.0::DOUBLE - {D}) / n + {D} * (coalesce(s.amount, 0) + d.mass / n)
        FROM ranks p
        LEFT JOIN (
            SELECT l.dst, sum(l.copies * r.rank / l.out_degree) AS amount
            FROM ranks r JOIN links l ON l.src = r.id GROUP BY l.dst) s ON s.dst = p.id
        CROSS JOIN (
            SELECT coalesce(sum(rank) FILTER (WHERE out_degree = 0), 0) AS mass FROM ranks) d
        CROSS JOIN total
        WHERE p.iteration < {iterations})"""


def ranked(name: str, iterations: int, select: str, dedupe: bool = True, more: str = "") -> str:
    return f"WITH RECURSIVE {graph(name, dedupe)}, {ranks(iterations)} {more} {select}"


def metrics(statistic: str, tol: str, from_first: bool) -> str:
    """CTEs for the metrics of every iteration, up to the first one that meets the stop rule."""
    compared = "TRUE" if from_first else "c.iteration > 1"
    return f""",
    changes AS (
        SELECT c.iteration, sum(c.rank) AS total_rank,
            coalesce(sum(c.rank) FILTER (WHERE c.out_degree = 0), 0) AS dangling_mass,
            max(abs(c.rank - p.rank)) FILTER (WHERE {compared}) AS max_delta,
            avg(abs(c.rank - p.rank)) FILTER (WHERE {compared}) AS avg_delta,
            sum(abs(c.rank - p.rank)) FILTER (WHERE {compared}) AS l1_delta
        FROM ranks c JOIN ranks p ON p.id = c.id AND p.iteration = c.iteration - 1
        GROUP BY c.iteration),
    judged AS (SELECT *, coalesce({statistic} < {tol}, FALSE) AS converged FROM changes),
    last AS (
        SELECT coalesce(min(iteration) FILTER (WHERE converged), max(iteration)) AS iteration
        FROM judged),
    history AS (SELECT * FROM judged WHERE iteration <= (SELECT iteration FROM last))"""


PAGE_MAX = metrics("max_delta", "1e-6", False)
PAGE_L1 = metrics("l1_delta", "1e-8", True)


def lines(expression: str) -> str:
    return f"lines AS (SELECT {expression} AS value FROM lineitem)"


EDGE_TOKENS = rf"""
    WITH {lines(graphs.EDGE_LINE)},
    kept AS (SELECT value, {TRIM} AS text FROM lines),
    tokens AS (SELECT value, text, regexp_split_to_array(text, '\s+') AS t
        FROM kept WHERE text <> '' AND NOT starts_with(text, '#'))"""

RECORDS = f"""
    WITH {lines(graphs.RECORD_LINE)},
    parts AS (
        SELECT value, string_split(value, chr(9)) AS p FROM lines WHERE {TRIM} <> ''),
    parsed AS (
        SELECT value, len(p) AS width, {TRIM.replace("value", "p[1]")} AS id,
            CASE WHEN len(p) = 3 THEN TRY_CAST(p[2] AS DOUBLE) END AS rank,
            list_filter(list_transform(string_split(p[len(p)], ','), lambda x: trim(x)), lambda x: x <> '')
                AS neighbors
        FROM parts),
    checked AS (
        SELECT *, CASE WHEN width NOT IN (2, 3) THEN 'wrong field count'
            WHEN width = 3 AND rank IS NULL THEN 'invalid rank'
            WHEN id = '' THEN 'empty node id' END AS reason
        FROM parsed)"""


def unrolled_pages(policy: str, iterations: int = 2) -> str:
    """Some iterations over page records only, whose targets are mostly unknown."""
    join = "LEFT JOIN" if policy == "drop" else "FULL OUTER JOIN"

    def one(before: str, after: str) -> str:
        return f"""
        {after} AS (
            SELECT coalesce(p.id, s.dst) AS id, coalesce(p.out_degree, 0)::BIGINT AS out_degree,
                (1.0::DOUBLE - {D}) / n + {D} * (coalesce(s.amount, 0) + d.mass / n) AS rank
            FROM {before} p
            {join} (
                SELECT e.dst, sum(r.rank / r.out_degree) AS amount
                FROM {before} r JOIN raw e ON e.src = r.id GROUP BY e.dst) s ON s.dst = p.id
            CROSS JOIN (
                SELECT coalesce(sum(rank) FILTER (WHERE out_degree = 0), 0) AS mass
                FROM {before}) d
            CROSS JOIN total)"""

    return f"""
    WITH raw AS MATERIALIZED ({graphs.SQL["page_links"]}),
    total AS (SELECT count(*)::DOUBLE AS n FROM pages),
    s0 AS (
        SELECT url AS id, count(dst)::BIGINT AS out_degree, 1.0::DOUBLE / any_value(n) AS rank
        FROM pages LEFT JOIN raw ON src = url CROSS JOIN total GROUP BY url),
    {", ".join(one(f"s{i}", f"s{i + 1}") for i in range(iterations))}
    SELECT id, out_degree, round(rank, 10) AS rank FROM s{iterations}"""


def adjacency(name: str, dedupe: bool, order: str = "dst") -> str:
    source = "SELECT DISTINCT src, dst FROM raw" if dedupe else "SELECT src, dst FROM raw"
    return f"""raw AS MATERIALIZED ({graphs.SQL[name]}),
    lists AS (
        SELECT id, 0::BIGINT AS part,
            coalesce(string_agg(dst, ',' ORDER BY {order}), '') AS neighbors
        FROM (SELECT src AS id FROM raw UNION SELECT dst FROM raw)
        LEFT JOIN ({source}) ON src = id GROUP BY id)"""


def parts(name: str, dedupe: bool, order: str, limit: int) -> str:
    """Lists cut after every ``limit`` neighbours of their final order."""
    source = "SELECT DISTINCT src, dst FROM raw" if dedupe else "SELECT src, dst FROM raw"
    return f"""WITH raw AS MATERIALIZED ({graphs.SQL[name]}),
    placed AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY {order}) - 1 AS place FROM ({source}))
    SELECT src AS id, CAST(place // {limit} AS BIGINT) AS part, string_agg(dst, ',' ORDER BY place) AS neighbors
    FROM placed GROUP BY ALL
    UNION ALL SELECT DISTINCT dst, 0::BIGINT, '' FROM raw WHERE dst NOT IN (SELECT src FROM raw)"""


HISTORY = """iteration, round(total_rank, 10) AS total_rank, round(dangling_mass, 10) AS dangling_mass,
    round(max_delta, 10) AS max_delta, round(avg_delta, 10) AS avg_delta, round(l1_delta, 10) AS l1_delta"""

STEP = f"""
    amounts AS (
        SELECT src, dst, copies * (1.0::DOUBLE / n) / out_degree AS amount FROM links, total),
    sums AS (SELECT dst, sum(amount) AS incoming FROM amounts GROUP BY dst),
    joined AS (
        SELECT id, out_degree, 1.0::DOUBLE / n AS rank, coalesce(incoming, 0.0) AS incoming
        FROM deg LEFT JOIN sums ON dst = id CROSS JOIN total)"""

DELTAS = """,
    deltas AS (
        SELECT c.id, c.rank, p.rank AS previous_rank, abs(c.rank - p.rank) AS delta
        FROM ranks c JOIN ranks p ON p.id = c.id
        WHERE c.iteration = 4 AND p.iteration = 3)"""


def oracle_sql() -> dict[str, str]:
    trade = graph("trade")
    pages = graph("page_links")
    return {
        "parse_edges_whitespace": f"{EDGE_TOKENS} SELECT t[1] AS src, t[2] AS dst FROM tokens "
        "WHERE len(t) = 2",
        "parse_edges_whitespace_at_least": f"{EDGE_TOKENS} SELECT t[1] AS src, t[2] AS dst "
        "FROM tokens WHERE len(t) >= 2",
        "parse_edges_tab": f"""
            WITH {lines(graphs.EDGE_LINE)},
            tokens AS (SELECT string_split({TRIM}, chr(9)) AS t FROM lines WHERE {TRIM} <> '')
            SELECT trim(t[1]) AS src, trim(t[2]) AS dst FROM tokens
            WHERE len(t) >= 2 AND trim(t[1]) <> '' AND trim(t[2]) <> ''""",
        "rejected_edges": f"{EDGE_TOKENS} SELECT value, 'wrong field count' AS reason "
        "FROM tokens WHERE len(t) <> 2",
        "parse_adjacency": f"{RECORDS} SELECT id, array_to_string(neighbors, ',') AS neighbors "
        "FROM checked WHERE width = 2 AND reason IS NULL",
        "parse_ranked_nodes": f"{RECORDS} SELECT id, round(rank, 10) AS rank, "
        "array_to_string(neighbors, ',') AS neighbors "
        "FROM checked WHERE width = 3 AND reason IS NULL",
        "rejected_records": f"{RECORDS} SELECT value, reason FROM checked "
        "WHERE reason IS NOT NULL",
        "reject_counts": f"{RECORDS} SELECT reason, count(*) AS lines FROM checked "
        "WHERE reason IS NOT NULL GROUP BY reason",
        "adjacency_lists_small_parts": parts("part_supp", False, "dst", 3),
        "neighbor_order_small_parts": parts("part_supp_numbers", True, "CAST(dst AS BIGINT)", 3),
        "adjacency_of_links": f"WITH {adjacency('part_supp', True)} SELECT * FROM lists",
        "adjacency_of_links_small_parts": parts("part_supp_numbers", True, "CAST(dst AS BIGINT)", 3),
        "text_parts_in_order": parts("part_supp", True, "dst", 3),
        "adjacency_text_parts_in_order": parts("part_supp", True, "dst", 3),
        "rank_total_of_text": ranked(
            "part_supp", 3,
            """SELECT round(sum(rank), 10) AS total_rank, round(abs(sum(rank) - 1), 10) AS error
            FROM ranks WHERE iteration = 3""",
        ),
        "top_k_of_text": ranked(
            "part_supp", 3,
            """SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 3
            ORDER BY round(ranks.rank, 12) DESC, id LIMIT 20""",
        ),
        "ranked_file_metrics": ranked(
            "trade", 4,
            """SELECT count(*) AS nodes, round(sum(rank), 10) AS total_rank,
            round(abs(sum(rank) - 1), 10) AS error,
            round(sum(rank) FILTER (WHERE id IN (SELECT id FROM deg WHERE out_degree = 0)), 10)
                AS dangling_mass,
            round(max(delta), 10) AS max_delta, round(avg(delta), 10) AS avg_delta,
            round(sum(delta), 10) AS l1_delta, max(delta) < 1e-6 AS converged FROM deltas""",
            more=DELTAS,
        ),
        "dedupe_edges": f"SELECT DISTINCT src, dst FROM ({graphs.SQL['page_links']})",
        "count_copies": f"SELECT src, dst, count(*) AS copies "
        f"FROM ({graphs.SQL['nation_trade']}) GROUP BY src, dst",
        "node_set": f"WITH {pages} SELECT id FROM ids",
        "node_count": f"WITH {trade} SELECT count(*) AS nodes FROM ids",
        "adjacency_record_count": f"{RECORDS} SELECT count(*) AS records FROM checked "
        "WHERE reason IS NULL",
        "adjacency_lists": f"WITH {adjacency('part_supp', True)} SELECT * FROM lists",
        "adjacency_multilists": f"WITH {adjacency('part_supp', False)} SELECT * FROM lists",
        "node_order": f"""WITH {graph('part_supp_numbers')}
            SELECT row_number() OVER (ORDER BY CAST(id AS BIGINT), id) AS position, id FROM ids""",
        "node_order_text": f"""WITH {pages}
            SELECT row_number() OVER (ORDER BY id) AS position, id FROM ids""",
        "neighbor_order": f"WITH {adjacency('part_supp_numbers', True, 'CAST(dst AS BIGINT)')} "
        "SELECT * FROM lists",
        "explode_adjacency": f"{RECORDS} SELECT id AS src, unnest(neighbors) AS dst FROM checked "
        "WHERE reason IS NULL",
        "out_degrees": f"WITH {pages} SELECT id, out_degree FROM deg",
        "linking_nodes": f"WITH {trade} SELECT id, out_degree FROM deg WHERE out_degree > 0",
        "dangling_nodes": f"WITH {pages} SELECT id FROM deg WHERE out_degree = 0",
        "graph_stats": f"""WITH {trade} SELECT count(*) AS nodes, sum(out_degree)::BIGINT AS edges,
            count(*) FILTER (WHERE out_degree = 0) AS dangling FROM deg""",
        "prepared_graph_stats": f"""WITH {graph('part_supp')}
            SELECT count(*) AS nodes, sum(out_degree)::BIGINT AS edges,
            count(*) FILTER (WHERE out_degree = 0) AS dangling FROM deg""",
        "initial_ranks": f"WITH {trade} SELECT id, round(1.0::DOUBLE / n, 10) AS rank "
        "FROM deg, total",
        "initial_dangling_mass": f"""WITH {pages} SELECT
            round(count(*) FILTER (WHERE out_degree = 0) / count(*)::DOUBLE, 10) AS dangling_mass
            FROM deg""",
        "adjacency_to_ranked": f"""WITH {adjacency('part_supp', True)}
            SELECT concat(id, chr(9), printf('%.15f', 1.0::DOUBLE / (SELECT count(*) FROM lists)),
            chr(9), neighbors) AS value FROM lists""",
        "prepare_graph": f"""WITH {adjacency('part_supp', True)}
            SELECT concat(id, chr(9), neighbors) AS value FROM lists""",
        "contributions": f"WITH {trade}, {STEP} SELECT src, dst, round(amount, 10) AS amount "
        "FROM amounts",
        "incoming_sums": f"WITH {trade}, {STEP} SELECT dst, round(incoming, 10) AS incoming "
        "FROM sums",
        "node_contribution_join": f"""WITH {trade}, {STEP}
            SELECT id, out_degree, round(rank, 10) AS rank, round(incoming, 10) AS incoming
            FROM joined""",
        "rank_step": ranked(
            "trade", 1,
            "SELECT id, out_degree, round(rank, 10) AS rank FROM ranks WHERE iteration = 1",
        ),
        "next_dangling_mass": ranked(
            "trade", 1,
            """SELECT round(coalesce(sum(rank), 0), 10) AS dangling_mass FROM ranks
            WHERE iteration = 1 AND out_degree = 0""",
        ),
        "rank_resume_materialize": unrolled_pages("materialize", 4),
        "rank_resume_converged": ranked(
            "page_links", 100, f"SELECT {HISTORY}, converged FROM history", more=PAGE_MAX
        ),
        "rank_reopen": ranked(
            "trade", 10, "SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 10"
        ),
        "rank_resume_latest": ranked(
            "trade", 5, "SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 5"
        ),
        "run_journal": ranked(
            "page_links", 100,
            """SELECT unnest([1, 2, 3])::BIGINT AS run, unnest([iteration, 2, 5])::BIGINT AS iterations,
            unnest([iteration, 2, 5])::BIGINT AS last_iteration, unnest([TRUE, FALSE, FALSE]) AS converged,
            (SELECT count(*) FROM deg) AS nodes, unnest([0.85, 0.5, 0.5])::DOUBLE AS damping,
            unnest([1e-6, NULL, NULL])::DOUBLE AS threshold FROM last""",
            more=PAGE_MAX,
        ),
        "iteration_metrics_l1": ranked(
            "trade", 4,
            "SELECT count(*) AS nodes, round(sum(delta), 10) AS l1_delta, sum(delta) < 0.5 AS converged FROM deltas",
            more=DELTAS,
        ),
        "history_of_snapshots_l1": ranked(
            "page_links", 4,
            f"SELECT {HISTORY}, coalesce(l1_delta < 0.1, FALSE) AS converged FROM judged",
            more=PAGE_MAX,
        ),
        "ranks_text_roundtrip_small_parts": ranked(
            "part_supp", 3,
            """SELECT r.id, round(r.rank, 10) AS rank, e.dst AS neighbor
            FROM ranks r LEFT JOIN edges e ON e.src = r.id WHERE r.iteration = 3""",
        ),
        "run_ledger_csv": f"""WITH {trade}
            SELECT 'spark' AS engine, 'trade' AS dataset, count(*) AS num_nodes,
                unnest([2, 3])::BIGINT AS iterations FROM deg""",
        "unknown_targets_drop": unrolled_pages("drop"),
        "unknown_targets_materialize": unrolled_pages("materialize"),
        "rank_fixed_iterations": ranked(
            "trade", 10, "SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 10"
        ),
        "rank_until_converged": ranked(
            "page_links", 100,
            "SELECT id, round(rank, 10) AS rank FROM ranks "
            "WHERE iteration = (SELECT iteration FROM last)",
            more=PAGE_MAX,
        ),
        "rank_until_converged_l1": ranked(
            "page_links", 100,
            "SELECT id, round(rank, 10) AS rank FROM ranks "
            "WHERE iteration = (SELECT iteration FROM last)",
            more=PAGE_L1,
        ),
        "rank_multigraph": ranked(
            "nation_trade", 5,
            "SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 5",
            dedupe=False,
        ),
        "rank_resume": ranked(
            "trade", 10, "SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 10"
        ),
        "rank_history": ranked(
            "trade", 4,
            "SELECT iteration, id, round(rank, 10) AS rank FROM ranks WHERE iteration > 0",
        ),
        "rank_total": ranked(
            "trade", 3,
            """SELECT round(sum(rank), 10) AS total_rank, round(abs(sum(rank) - 1), 10) AS error
            FROM ranks WHERE iteration = 3""",
        ),
        "rank_delta": ranked(
            "trade", 4,
            """SELECT id, round(rank, 10) AS rank, round(previous_rank, 10) AS previous_rank,
            round(delta, 10) AS delta FROM deltas""",
            more=DELTAS,
        ),
        "rank_delta_summary": ranked(
            "trade", 4,
            "SELECT round(max(delta), 10) AS max_delta, round(avg(delta), 10) AS avg_delta "
            "FROM deltas",
            more=DELTAS,
        ),
        "rank_delta_l1": ranked(
            "trade", 4,
            "SELECT round(sum(delta), 10) AS l1_delta, count(*) AS nodes FROM deltas",
            more=DELTAS,
        ),
        "convergence_history": ranked(
            "page_links", 100,
            """SELECT iteration, round(total_rank, 10) AS total_rank,
            round(dangling_mass, 10) AS dangling_mass, round(max_delta, 10) AS max_delta,
            round(avg_delta, 10) AS avg_delta, round(l1_delta, 10) AS l1_delta, converged
            FROM history""",
            more=PAGE_MAX,
        ),
        "iteration_metrics": ranked(
            "trade", 4,
            """SELECT count(*) AS nodes, round(sum(rank), 10) AS total_rank,
            round(abs(sum(rank) - 1), 10) AS error,
            round(sum(rank) FILTER (WHERE id IN (SELECT id FROM deg WHERE out_degree = 0)), 10)
                AS dangling_mass,
            round(max(delta), 10) AS max_delta, round(avg(delta), 10) AS avg_delta,
            max(delta) < 1e-6 AS converged FROM deltas""",
            more=DELTAS,
        ),
        "history_of_snapshots": ranked(
            "page_links", 4,
            """SELECT iteration, round(total_rank, 10) AS total_rank,
            round(dangling_mass, 10) AS dangling_mass, round(max_delta, 10) AS max_delta,
            round(avg_delta, 10) AS avg_delta, round(l1_delta, 10) AS l1_delta, converged
            FROM judged""",
            more=PAGE_MAX,
        ),
        "compare_runs": f"""
            WITH u AS ({ranked("trade", 3, "SELECT id, rank FROM ranks WHERE iteration = 3")}),
            m AS ({ranked("trade", 3, "SELECT id, rank FROM ranks WHERE iteration = 3", False)}),
            up AS (SELECT id, row_number() OVER (ORDER BY rank DESC, id) AS place FROM u),
            mp AS (SELECT id, row_number() OVER (ORDER BY rank DESC, id) AS place FROM m)
            SELECT u.id, round(u.rank, 10) AS rank, round(m.rank, 10) AS previous_rank,
                round(abs(u.rank - m.rank), 10) AS delta,
                CASE WHEN up.place <= 20 THEN up.place ELSE 0 END AS place,
                CASE WHEN mp.place <= 20 THEN mp.place ELSE 0 END AS other_place
            FROM u JOIN m ON m.id = u.id JOIN up ON up.id = u.id JOIN mp ON mp.id = u.id""",
        "history_of_stored_snapshots": ranked(
            "page_links", 4, f"SELECT {HISTORY}, converged FROM judged", more=PAGE_MAX
        ),
        "compare_runs_all_places": f"""
            WITH u AS ({ranked("trade", 3, "SELECT id, rank FROM ranks WHERE iteration = 3")}),
            m AS ({ranked("trade", 3, "SELECT id, rank FROM ranks WHERE iteration = 3", False)})
            SELECT u.id, round(u.rank, 10) AS rank, round(m.rank, 10) AS previous_rank,
                round(abs(u.rank - m.rank), 10) AS delta, TRUE AS placed, TRUE AS other_placed
            FROM u JOIN m ON m.id = u.id""",
        "top_k_positions_all": ranked(
            "trade", 5,
            """SELECT row_number() OVER (ORDER BY round(ranks.rank, 12) DESC, id) AS position, id,
            round(rank, 10) AS rank FROM ranks WHERE iteration = 5""",
        ),
        "top_k": ranked(
            "trade", 5,
            """SELECT id, round(rank, 10) AS rank FROM ranks WHERE iteration = 5
            ORDER BY ranks.rank DESC, id LIMIT 20""",
        ),
        "top_k_positions": ranked(
            "trade", 5,
            """SELECT row_number() OVER (ORDER BY ranks.rank DESC, id) AS position, id,
            round(rank, 10) AS rank FROM ranks WHERE iteration = 5 ORDER BY 1 LIMIT 10""",
        ),
        "top_k_ties": ranked(
            "nation_trade", 2,
            """SELECT row_number() OVER (ORDER BY round(ranks.rank, 12) DESC, id) AS position, id,
            round(rank, 10) AS rank FROM ranks WHERE iteration = 2""",
        ),
        "ranking_full": ranked(
            "trade", 5,
            """SELECT row_number() OVER (ORDER BY round(ranks.rank, 12) DESC, id) AS position, id,
            round(rank, 10) AS rank FROM ranks WHERE iteration = 5""",
        ),
        "latest_snapshot": ranked(
            "trade", 3,
            "SELECT iteration, id, round(rank, 10) AS rank FROM ranks WHERE iteration = 3",
        ),
        "ranks_text_roundtrip": ranked(
            "part_supp", 3,
            """SELECT r.id, round(r.rank, 10) AS rank, coalesce(n.neighbors, '') AS neighbors
            FROM ranks r LEFT JOIN (
                SELECT src, string_agg(dst, ',' ORDER BY dst) AS neighbors FROM edges GROUP BY src
            ) n ON n.src = r.id WHERE r.iteration = 3""",
        ),
        "top_report_csv": ranked(
            "trade", 5,
            """SELECT id AS node, round(rank, 10) AS rank FROM ranks WHERE iteration = 5
            ORDER BY ranks.rank DESC, id LIMIT 20""",
        ),
        "convergence_report_csv": ranked(
            "page_links", 100,
            """SELECT iteration, round(total_rank, 10) AS total_rank,
            round(dangling_mass, 10) AS dangling_mass, round(max_delta, 10) AS max_delta,
            round(avg_delta, 10) AS average_delta,
            CASE WHEN converged THEN 'YES' ELSE 'NO' END AS converged FROM history""",
            more=PAGE_MAX,
        ),
        "run_summary": ranked(
            "page_links", 100,
            """SELECT 'spark' AS implementation, 'page_links' AS dataset,
            (SELECT count(*) FROM deg) AS nodes, 0.85::DOUBLE AS damping,
            iteration AS iterations, converged, round(total_rank, 10) AS total_rank
            FROM history WHERE iteration = (SELECT iteration FROM last)""",
            more=PAGE_MAX,
        ),
        "run_ledger": f"""WITH {trade}
            SELECT 'spark' AS engine, 'trade' AS dataset, count(*) AS num_nodes,
                unnest([2, 3])::BIGINT AS iterations FROM deg""",
    }
