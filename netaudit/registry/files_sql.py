"""Plain SQL of the queries that go through files; shared parts are those of the other SQL."""

from __future__ import annotations

from netaudit import constants as C
from netaudit.registry.files import HEADER, STAMP
from netaudit.registry.oracle import HOST, NULLS, REVIEW_LINES, SQL, TREND, TREND_MONTHS, ip10, mac, with_parts

NAMES = [*C.REPORT_NAMES, "Other Thing"]
REPORT_OF = "CASE c_custkey % 8 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NAMES)) + " END"
OF_USERS = C.REPORT_NAMES.index(C.USER_REPORT)
TABLE_OF = f"CASE WHEN c_custkey % 8 = {OF_USERS} THEN 'top10Destinations' ELSE '{C.TERMINAL_TABLE}' END"
VPN_FILE = "CASE user_id % 5 WHEN 0 THEN 'vpn199806.log' WHEN 1 THEN 'vpn199807.log' WHEN 2 THEN 'vpn199809.log' WHEN 3 THEN 'access.log' ELSE 'access.log.1' END"

# The months of the fiscal year, all without record, under the names of their files.
REVIEW_LOOP = f"""SELECT '{HEADER} ' || yyyymm || '.md' AS file, concat_ws(chr(10), {', '.join(REVIEW_LINES)}) AS text, 0::BIGINT AS missing FROM (
    SELECT yyyymm, y::VARCHAR AS year, nullif(split_part(eventDate, '/', 1), '') AS eventMonth, nullif(split_part(eventDate, '/', 2), '') AS eventDay
    FROM calendar WHERE yyyymm BETWEEN '199804' AND '199903')"""

FILE_SQL = {
    "read_report_files": f"""SELECT report, table_name, column_name, value, count(*) AS cells FROM (
        SELECT {REPORT_OF} AS report, {TABLE_OF} AS table_name, unnest(['User_or_IP_', 'Note', 'rank']) AS column_name,
          unnest([{ip10('c_custkey')}, 'n' || c_custkey % 5, CASE WHEN c_custkey % 8 = {OF_USERS} THEN (c_custkey % 5) || ': ' || {ip10('c_custkey')} || ' u' END]) AS value
        FROM customer WHERE c_custkey % 8 <> 7) WHERE value IS NOT NULL GROUP BY ALL""",
    "listed_files": f"""SELECT DISTINCT {REPORT_OF} || '-{STAMP}_1234.xml' AS file, {REPORT_OF} AS report, c_custkey % 8 <> 7 AS known FROM customer""",
    "read_lease_files": f"""SELECT {ip10('c_custkey')} AS ip, {mac('c_custkey')} AS "macAddress",
        CASE WHEN c_nationkey % 3 = 0 THEN CASE WHEN coalesce({HOST}, '') = '' THEN '{C.BLANK_HOST}' ELSE {HOST} END
        ELSE nullif({HOST}, '') END AS "hostName" FROM customer WHERE c_custkey % 17 <> 0 AND c_nationkey % 3 < 2""",
    "read_config_file": """SELECT 'FIREWL01_1999-08.conf' AS file, row_number() OVER (ORDER BY c_custkey) AS line_no, 'set name ' || c_name AS line
        FROM customer""",
    "read_vpn_files": f"""SELECT file, line, count(*) AS lines FROM (SELECT {VPN_FILE} AS file, 'user ' || user_id || ' ' || event_type AS line FROM events)
        WHERE file IN ('vpn199806.log', 'vpn199807.log', 'access.log') GROUP BY ALL""",
    "register_snapshots": f"""SELECT ip, hostName AS "hostName", {NULLS} AS "macAddress", true AS written, false AS replaced FROM denied""",
    "parameter_files": """SELECT 'parameter' AS kind, '10.' || s_suppkey % 256 || '.' || s_suppkey // 256 || '.0/24' AS value FROM supplier WHERE s_suppkey % 3 = 1
        UNION ALL SELECT 'setting', 'item' || s_suppkey || '=' || s_name FROM supplier
        UNION ALL SELECT 'user', 'u' || s_suppkey FROM (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS line FROM supplier) WHERE line > 2""",
    "review_loop": REVIEW_LOOP,
    "mac_files": "SELECT mac, file || '.txt:' || line AS value FROM (" + SQL["mac_search"] + ")",
    "trend_files": f"""SELECT application, size, bandwidth, yyyymm FROM ({TREND} WHERE yyyymm IN ({TREND_MONTHS}))""",
}

FILE_ORACLE = {name: with_parts(sql) for name, sql in FILE_SQL.items()}
