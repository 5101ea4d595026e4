"""Plain SQL of the queries that run whole jobs."""

from __future__ import annotations

from netaudit import constants as C
from netaudit.registry.oracle import SQL, TREND_MONTHS, mac, with_parts
from netaudit.registry.runs import FIRST_DAY, SECOND_DAY


def valid(day) -> str:
    return f"SELECT o_orderkey || '|' || o_custkey AS row FROM orders WHERE o_orderstatus = 'O' OR o_orderdate::DATE >= DATE '{day}'"


RUN_SQL = {
    "converted_records": """SELECT 'record ' || targetYm || '.txt' AS name, targetYm || chr(10) || name AS text, '1,0' AS runs FROM calendar""",
    "scalar_registers": "SELECT s_name AS name FROM supplier",

    "dropped_counts": f"""SELECT 'blocks without MAC' AS what, (SELECT count(*) FROM customer WHERE ends_with({mac('c_custkey // 2')}, '0')) AS rows
        UNION ALL SELECT 'ranges without addresses', 0 UNION ALL SELECT 'malformed networks', (SELECT count(*) FROM networks WHERE bad)
        UNION ALL SELECT 'sizes in other units', (SELECT count(*) FROM ({SQL["bandwidth_trend"]}) WHERE ends_with(size, '7 MB'))""",

    "sorted_devices": f"""SELECT ip, hostName AS "hostName", row_number() OVER (ORDER BY ip NULLS FIRST, hostName NULLS FIRST, "user" NULLS FIRST, description NULLS FIRST, "macAddress" NULLS FIRST) - 1 AS position
        FROM ({SQL["device_register"]})""",
    "sorted_trend": f"""SELECT application, yyyymm, size, row_number() OVER (ORDER BY "applicationsRank" DESC, application NULLS FIRST, yyyymm, size) - 1 AS position FROM ({SQL["bandwidth_trend"]})""",
    "sorted_sessions": """SELECT array_to_string(w, ' ') AS line, row_number() OVER (ORDER BY w[2], f, event_id) - 1 AS position FROM vpn_words WHERE event_type IN ('click', 'view') AND w[1] = 'Jan'""",
    "large_table": f"""SELECT '{C.TERMINAL_TABLE}' AS table_name, o_orderkey::VARCHAR AS key, 'c & ' || o_custkey AS who1, o_orderstatus AS who2 FROM orders""",

    "refreshed_registers": f"""SELECT 'users' AS register, row, 1 AS version FROM ({valid(FIRST_DAY)}) UNION ALL SELECT 'users', row, 2 FROM ({valid(SECOND_DAY)})
        UNION ALL SELECT 'assets', CASE WHEN s_suppkey % 3 <> 1 THEN 'PC-' || n || CASE WHEN n % 2 = 1 THEN '-NB' ELSE '' END ELSE '-' END || '|NATION_' || s_nationkey, 1
        FROM (SELECT *, CASE WHEN s_suppkey % 4 = 3 THEN s_suppkey - 1 ELSE s_suppkey END AS n FROM supplier)""",
    "config_job": f"""SELECT 'deny_list' AS register, coalesce(ip, '-') || '|' || coalesce(hostName, '-') || '|-' AS row FROM ({SQL["config_deny_list"]})
        UNION ALL SELECT 'deny_list_export', coalesce(ip, '-') || '|' || coalesce(hostName, '-') FROM ({SQL["config_deny_list"]})
        UNION ALL SELECT 'dhcp_ranges', interface || '|' || lo || '|' || hi FROM ({SQL["config_dhcp_ranges"]})
        UNION ALL SELECT 'blocked_macs', "macAddress" || '|' || coalesce(action, '-') || '|' || coalesce(description, '-') || '|' || coalesce("interFace", '-') FROM ({SQL["config_blocked_macs"]})""",
    "vpn_job": f"""SELECT 'vpn' AS register, ip || '|' || coalesce("user", '-') AS row FROM ({SQL["vpn_sessions"]})
        UNION ALL SELECT 'vpn_local', ip FROM ({SQL["vpn_local_ips"]})""",
    "room_log": """WITH r AS (SELECT 'room-' || event_type || '.csv' AS file, strftime(ts, '%Y/%m/%d') AS day, event_type IN ('click', 'signup') AS swapped,
          nullif(['山田 太郎', 'ソ能表', '髙﨑①', 'Ito, Ken', ''][user_id % 5 + 1], '') AS name FROM events)
        SELECT file, column_name, value, count(*) AS rows FROM (SELECT file, '時刻' AS column_name, day AS value FROM r UNION ALL SELECT file, '氏名', name FROM r) GROUP BY ALL""",
    "provider_networks": """SELECT s_name AS "User", '192.' || s_suppkey % 256 || '.' || s_suppkey // 256 || '.0/24' AS cidr, 0 AS rank FROM supplier
        UNION ALL SELECT [(SELECT n_name FROM nation WHERE n_nationkey = 0), (SELECT n_name FROM nation WHERE n_nationkey = 1), 'own'][c_custkey % 4 + 1],
          '10.' || c_custkey % 256 || '.' || c_custkey // 256 || '.0/24', (c_custkey % 4 + 1)::INTEGER FROM customer WHERE c_custkey % 4 < 3""",
    "monthly_audit": f"""SELECT report, table_name, column_name, value, count(*) AS rows FROM ({SQL["report_enrichment"]}) GROUP BY ALL""",
    "trend_again": f"""SELECT *, 13 AS first_read, '199907' AS then_read FROM ({SQL["chart_series"]}) WHERE yyyymm IN ({TREND_MONTHS})""",
}

RUN_ORACLE = {name: with_parts(sql) for name, sql in RUN_SQL.items()}
