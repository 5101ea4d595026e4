"""Plain SQL for the registered queries, by other means than the library's where that is possible.

Theta joins, one global window or correlated lookups are fine here: this runs at small scale.
"""

from __future__ import annotations

import re

from netaudit import constants as C
from netaudit.plans.reports import DESTINATION_COLUMNS
from netaudit.registry.inputs import TABLE_OF_REST, TEN
from netaudit.registry.queries import APPROVER, CREATOR, PARTICIPANTS, TODAY, TREND_PERIOD, XML_SINCE

IP = "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"
DOMAIN = "[a-z0-9.-]+[.][a-z]{2,}"


def ip10(n: str) -> str:
    return f"('10.' || (({n}) // 65536) % 256 || '.' || (({n}) // 256) % 256 || '.' || ({n}) % 256)"


def ip_of(n: str) -> str:
    return f"(({n}) // 16777216 || '.' || (({n}) // 65536) % 256 || '.' || (({n}) // 256) % 256 || '.' || ({n}) % 256)"


def number(ip: str) -> str:
    parts = [f"split_part({ip}, '.', {i})::BIGINT" for i in range(1, 5)]
    return f"({parts[0]} * 16777216 + {parts[1]} * 65536 + {parts[2]} * 256 + {parts[3]})"


def mac(n: str) -> str:
    digits = f"lpad(({n})::VARCHAR, 12, '0')"
    return "(" + " || ':' || ".join(f"substr({digits}, {i}, 2)" for i in range(1, 13, 2)) + ")"


def extract(text: str, pattern: str) -> str:
    return f"nullif(regexp_extract({text}, '{pattern}'), '')"


def is_ip(ip: str) -> str:
    return f"regexp_matches({ip}, '{IP}$')"


HOST = """CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN NULL
 WHEN c_custkey % 13 = 0 THEN 'pc.' || (c_custkey % 50) ELSE 'pc-' || c_custkey END"""
CONFIG_ADDRESS = "'198.51.' || (c_custkey // 256) % 256 || '.' || c_custkey % 256"
LINE_START = "strftime(ts, '%b ') || day(ts) || strftime(ts, ' %H:%M:%S') || ' gw vpn[1]: '"


def rest_case(index: int) -> str:
    return "CASE c_custkey % 8 " + " ".join(f"WHEN {r} THEN '{names[index]}'" for r, names in enumerate(TABLE_OF_REST)) + " END"


NULLS = "NULL::VARCHAR"

# Shared parts, each may use the ones before it.
PARTS = {
    "leases": f"""SELECT c_custkey AS pos, {ip10('c_custkey')} AS ip, {mac('c_custkey')} AS macAddress,
        CASE WHEN ({HOST}) = '' THEN '{C.BLANK_HOST}' ELSE {HOST} END AS hostName FROM customer""",
    "assets": f"""SELECT s_suppkey AS pos, CASE WHEN s_suppkey % 17 <> 5 THEN s_name END AS "user",
        'NATION_' || s_nationkey AS description,
        CASE WHEN s_suppkey % 3 <> 1 THEN 'pc-' || n || CASE WHEN n % 2 = 1 THEN '-nb' ELSE '' END END AS key
        FROM (SELECT *, CASE WHEN s_suppkey % 4 = 3 THEN s_suppkey - 1 ELSE s_suppkey END AS n FROM supplier)
        WHERE s_suppkey % 10 <> 0""",
    "static_devices": f"""SELECT s_suppkey AS pos, {ip10('s_suppkey * 3')} AS ip, 'srv-' || s_suppkey AS hostName,
        CASE WHEN s_suppkey % 2 = 0 THEN s_name WHEN s_suppkey % 3 = 0 THEN 'purpose-' || s_suppkey % 5 END AS "user",
        'NATION_' || s_nationkey AS description FROM supplier WHERE s_suppkey % 9 <> 0 AND s_suppkey % 10 <> 1""",
    "denied": f"""SELECT s_suppkey AS pos, CASE WHEN s_suppkey % 2 = 0 THEN {ip10('s_suppkey * 5 + 1')}
        WHEN s_suppkey % 8 <> 7 THEN 'bad' || s_suppkey || '.example.net' END AS ip, 'Black' || s_suppkey AS hostName
        FROM supplier""",
    "pattern_domains": """SELECT 'c' || c_custkey || '.n' || c_nationkey || '.example.' || ['com', 'net', 'org'][c_custkey % 3 + 1] AS domain FROM customer""",
    "domain_patterns": r"""SELECT s_name AS owner, s_suppkey AS pos, s_suppkey % 8 = 6 AS broken, CASE s_suppkey % 8
        WHEN 0 THEN '^c[0-9]*' || s_suppkey % 10 || '\.n' || s_nationkey || '\.example\.(com|net)'
        WHEN 1 THEN '(n' || s_nationkey || '|n' || s_suppkey % 25 || ')\.example\.com' WHEN 2 THEN 'c' || s_suppkey || '[0-9]?\.n[0-9]+\.example\.org'
        WHEN 3 THEN '^c(?:' || s_suppkey || '|' || s_suppkey + 1 || '){1,2}\..*' WHEN 4 THEN '\bc' || s_suppkey || '\.n' || s_nationkey || '|c' || s_suppkey + 2 || '\.n.*net'
        WHEN 5 THEN 'c' || s_suppkey || '+\.n\d+\.example\.com' WHEN 6 THEN 'c' || s_suppkey || '(.n'
        ELSE 'c' || s_suppkey || '.n' || s_nationkey || '.example.org' END AS pattern FROM supplier""",
    "pattern_assets": "SELECT c_custkey AS pos, c_name AS \"user\", 'pc-' || c_custkey || '-n' || c_nationkey || CASE WHEN c_custkey % 2 = 1 THEN '-nb' ELSE '' END AS key FROM customer",
    "host_patterns": r"""SELECT DISTINCT s_suppkey % 8 = 6 AS broken, CASE s_suppkey % 8 WHEN 0 THEN 'pc-[0-9]+-n' || s_nationkey || '-nb'
        WHEN 1 THEN 'pc-(' || s_suppkey || '|' || s_suppkey * 2 || ')-' WHEN 2 THEN 'pc-' || s_suppkey || '?[0-9]-'
        WHEN 3 THEN '.*' || s_suppkey % 10 || '-n' || s_nationkey || '$' WHEN 4 THEN 'pc-' || s_suppkey + 3 || '-|pc-' || s_suppkey || '-n'
        WHEN 5 THEN '(?i)PC-' || s_suppkey || '\d{1,2}-' WHEN 6 THEN 'pc-' || s_suppkey || '[-' ELSE 'pc.' || s_suppkey || '-' END AS host FROM supplier""",
    "page_domains": f"SELECT page_id, {extract('url', DOMAIN)} AS domain FROM pages",
    "allowed": """SELECT page_id * 2 AS pos, replace(regexp_replace(domain, '^[a-z]+[.]', ''), '-', '.') AS ip,
        'allow-' || page_id AS hostName FROM page_domains UNION ALL
        SELECT page_id * 2 + 1, substr(domain, 4), 'allow-' || page_id FROM page_domains""",
    "networks": """SELECT 'site-' || s_suppkey AS "User", '10.0.' || s_suppkey % 256 AS head,
        CASE WHEN s_suppkey % 6 = 5 THEN '.1/24' ELSE '.0/24' END AS tail, 24 AS bits, s_suppkey % 6 = 5 AS bad,
        0 AS grp, s_suppkey AS pos, 10 * 16777216::BIGINT + (s_suppkey % 256) * 256 AS low FROM supplier
        UNION ALL SELECT n_name || '/' || b, o::VARCHAR, '.0.0.0/' || b, b, false, 1, o * 2 + b - 9, o * 16777216::BIGINT
        FROM nation, range(1, 256) r(o), (VALUES (8), (9)) v(b)
        WHERE o % 25 = n_nationkey AND (b = 8 OR o % 2 = 0)""",
    "good_networks": """SELECT *, low + (1::BIGINT << (32 - bits)) - 1 AS high FROM networks WHERE NOT bad""",
    "lans": f"""SELECT 'lan' || s_suppkey AS interface, {TEN} + s_suppkey * 20 AS lo, {TEN} + s_suppkey * 20 + 14 AS hi FROM supplier
        UNION ALL SELECT 'wifi' || s_suppkey, {TEN} + s_suppkey * 20 + 10, {TEN} + s_suppkey * 20 + 18 FROM supplier""",
    "host_keys": "SELECT DISTINCT hostName, lower(hostName) AS key FROM leases WHERE macAddress IS NOT NULL",
    "prefix_matches": """SELECT k.key, arg_min(struct_pack(u := a."user", d := a.description), a.pos) AS m
        FROM (SELECT DISTINCT key FROM host_keys WHERE key <> '') k JOIN assets a
        ON regexp_matches(a.key, '^(?:' || k.key || ')') GROUP BY k.key""",
    "prefix_matches_literal": """SELECT k.key, arg_min(struct_pack(u := a."user", d := a.description), a.pos) AS m
        FROM (SELECT DISTINCT key FROM host_keys WHERE key <> '') k JOIN assets a
        ON starts_with(a.key, k.key) GROUP BY k.key""",
    "owners": """SELECT h.hostName, CASE WHEN a."user" IS NULL AND p.m IS NOT NULL THEN p.m.u ELSE a."user" END AS "user",
        CASE WHEN a."user" IS NULL AND p.m IS NOT NULL THEN p.m.d ELSE a.description END AS description
        FROM host_keys h LEFT JOIN assets a ON h.key = a.key LEFT JOIN prefix_matches p ON h.key = p.key""",
    "all_devices": f"""SELECT 0 AS grp, pos, ip, hostName, "user", description, {NULLS} AS macAddress FROM static_devices
        UNION ALL SELECT 1, pos, ip, hostName, NULL, NULL, macAddress FROM leases
        UNION ALL SELECT 2, pos, ip, hostName, NULL, NULL, NULL FROM denied
        UNION ALL SELECT 3, pos, ip, hostName, NULL, NULL, NULL FROM allowed
        UNION ALL SELECT 4, 0, '127.0.0.1', 'localhost', NULL, NULL, NULL""",
    "first_devices": """SELECT ip, hostName, "user", description, macAddress FROM (SELECT *,
        row_number() OVER (PARTITION BY ip ORDER BY grp, pos) AS rn FROM all_devices) WHERE rn = 1""",
    "vpn_pairs": f"SELECT DISTINCT {ip10('user_id * 11')} AS ip, 'u' || user_id AS \"user\" FROM events WHERE event_type = 'click'",
    "vpn_local": f"SELECT DISTINCT {ip10('user_id + 500000')} AS ip FROM events WHERE event_type = 'signup'",
    "register": f"""SELECT ip, hostName, CASE WHEN hostName = '{C.BLANK_HOST}' THEN '{C.BLANK_HOST}'
            WHEN hostName IS NOT NULL THEN "user" END AS "user", description, macAddress FROM (
        SELECT d.ip, d.hostName, o."user", o.description, d.macAddress FROM first_devices d
            JOIN owners o ON d.hostName IS NOT DISTINCT FROM o.hostName WHERE d.macAddress IS NOT NULL
        UNION ALL SELECT * FROM first_devices WHERE macAddress IS NULL)
        UNION ALL SELECT ip, '{C.VPN_HOST}', "user", NULL, NULL FROM vpn_pairs
        UNION ALL SELECT ip, '{C.VPN_LOCAL_HOST}', NULL, NULL, NULL FROM vpn_local""",
    "people": f"""SELECT c_custkey AS place, {rest_case(0)} AS report, {rest_case(1)} AS table_name, c_custkey % 8 AS kind,
        CASE c_custkey % 8 WHEN 0 THEN 'ssh(' || {ip10('c_custkey')} || ')' WHEN 1 THEN 'from ' || {ip10('c_custkey')}
          WHEN 5 THEN {ip10('c_custkey - c_custkey % 16')}
          WHEN 7 THEN CASE c_custkey % 24 WHEN 7 THEN 'srcip' WHEN 15 THEN 'dstip' END
          ELSE {ip10('c_custkey')} END AS cell, c_name FROM customer""",
    "doc_hosts": f"SELECT doc_id AS place, {extract('text', IP)} AS cell, lang FROM documents",
    "visits": f"""SELECT page_id AS place, domain, {ip10('page_id * 7')} AS src,
        (page_id % 5 + 1)::VARCHAR AS rank, page_id % 900 || ' MB' AS usage,
        (page_id % 5 + 1) || ': ' || {ip10('page_id * 7')} || ' user Usage: ' || page_id % 900 || ' MB' AS section
        FROM page_domains""",
    "cells": """SELECT cell FROM people UNION ALL SELECT c_name FROM people WHERE kind = 4 UNION ALL SELECT cell FROM doc_hosts
        UNION ALL SELECT lang FROM doc_hosts UNION ALL SELECT domain FROM visits UNION ALL SELECT src FROM visits
        UNION ALL SELECT section FROM visits UNION ALL SELECT usage FROM visits UNION ALL SELECT 'HTTPS'""",
    "keys": f"""SELECT {extract('cell', IP + '$')} AS ip FROM cells UNION SELECT {extract('cell', DOMAIN)} FROM cells""",
    "found_keys": "SELECT ip FROM keys WHERE ip IS NOT NULL",
    "domain_rows": f"""SELECT k.ip, m.hostName, m."user", m.description, m.macAddress FROM
        (SELECT ip FROM found_keys WHERE NOT {is_ip('ip')}) k LEFT JOIN
        (SELECT k.ip AS k, arg_min(r, r.ip) AS r FROM found_keys k JOIN register r
          ON regexp_matches(k.ip, '(?:' || r.ip || ')$') AND NOT {is_ip('r.ip')} WHERE NOT {is_ip('k.ip')} GROUP BY k.ip) x
        ON k.ip = x.k LEFT JOIN LATERAL (SELECT (x.r).hostName AS hostName, (x.r)."user" AS "user",
          (x.r).description AS description, (x.r).macAddress AS macAddress) m ON true""",
    "joined": f"""SELECT k.ip, r.hostName, r."user", r.description, r.macAddress FROM found_keys k
        LEFT JOIN register r ON k.ip = r.ip WHERE {is_ip('k.ip')} UNION ALL SELECT * FROM domain_rows""",
    "released": f"""SELECT j.ip, j.description, j.macAddress,
        CASE WHEN j.macAddress IS NULL THEN '{C.RELEASED}' ELSE '{C.BLANK_HOST}' END AS label
        FROM (SELECT * FROM joined WHERE hostName IS NULL AND {is_ip('ip')}) j JOIN lans l
        ON {number('j.ip')} BETWEEN l.lo AND l.hi""",
    "after_release": """SELECT ip, hostName, "user", description, macAddress FROM joined WHERE ip NOT IN (SELECT ip FROM released)
        UNION ALL SELECT ip, label, label, description, macAddress FROM released""",
    "after_labels": f"""SELECT ip, hostName, CASE WHEN hostName IS NOT NULL AND macAddress IS NOT NULL AND "user" IS NULL
        THEN '{C.UNREGISTERED}' ELSE "user" END AS "user", description, macAddress FROM after_release""",
    "found_networks": f"""SELECT i.ip, arg_min(n."User", n.grp * 1000000000000 + n.pos) AS hostName
        FROM (SELECT DISTINCT ip FROM after_labels WHERE hostName IS NULL AND {is_ip('ip')}) i JOIN good_networks n
        ON {number('i.ip')} BETWEEN n.low AND n.high GROUP BY i.ip""",
    "identities": """SELECT * FROM after_labels WHERE ip NOT IN (SELECT ip FROM found_networks)
        UNION ALL SELECT a.ip, f.hostName, a."user", a.description, a.macAddress
        FROM after_labels a JOIN found_networks f ON a.ip = f.ip""",
    "known": f"""SELECT ip, CASE WHEN k THEN hostName END AS hostName,
        CASE WHEN k AND n % 2 = 0 THEN 'u-' || ip END AS "user", {NULLS} AS description, CASE WHEN k THEN macAddress END AS macAddress
        FROM (SELECT *, {number('ip')} AS n, {number('ip')} % 5 <> 0 AS k FROM leases)""",
    "known_released": f"""SELECT k.ip, k.macAddress, CASE WHEN k.macAddress IS NULL THEN '{C.RELEASED}' ELSE '{C.BLANK_HOST}' END AS label
        FROM known k JOIN lans l ON {number('k.ip')} BETWEEN l.lo AND l.hi WHERE k.hostName IS NULL""",
    "deny_lines": f"""SELECT 'FW-' || c_nationkey AS file, c_custkey * 20 + j AS pos, line FROM (
        SELECT c_nationkey, c_custkey, 0 AS j, CASE WHEN c_custkey % 3 <> 2 THEN 'edit "Black' ELSE 'edit "White' END || c_custkey || ' host"' AS line FROM customer
        UNION ALL SELECT c_nationkey, c_custkey, 1, CASE c_custkey % 4 WHEN 0 THEN 'S' || {CONFIG_ADDRESS}
          WHEN 1 THEN 'S' || {CONFIG_ADDRESS} || ' 255.255.255.0' WHEN 2 THEN 'Sbad' || c_custkey || '.example.com' END FROM customer
        UNION ALL SELECT c_nationkey, c_custkey, 2, CASE WHEN c_custkey % 10 <> 9 THEN 'next' END FROM customer)
        WHERE line IS NOT NULL""",
    "interfaces": """SELECT *, max(CASE WHEN c_custkey % 4 <> 1 THEN c_custkey // 10 END)
        OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS port FROM customer""",
    "vpn_words": f"""SELECT user_id % 4 AS f, event_id, string_split({LINE_START} || CASE event_type
          WHEN 'click' THEN 'peer connected from ' || {ip10('user_id')} || CASE WHEN user_id % 5 = 0 THEN ' u' || user_id ELSE '' END
          WHEN 'view' THEN 'Call detected from user u' || user_id
          WHEN 'signup' THEN 'PPP/IPCP up (local addr = ' || {ip10('user_id + 1000')} || ')'
          ELSE 'keepalive ' || event_type END, ' ') AS w, event_type FROM events""",
    "months": "SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS yyyymm, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders",
    "sums": f"""SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, CASE WHEN o_custkey % 40 < 8
          THEN ({C.CHART_APPLICATIONS!r})[(o_custkey % 40 + 1)::INT] ELSE 'tcp/' || o_custkey % 40 END AS application,
        sum(o_totalprice::DECIMAL(18,2)) AS price, count(*) AS sessions FROM orders GROUP BY 1, 2""",
    "monthly": f"""SELECT *, (price * 100)::BIGINT // 5000 AS mb FROM (
        SELECT *, row_number() OVER (PARTITION BY yyyymm ORDER BY price DESC, application) AS rank FROM sums
        UNION ALL SELECT yyyymm, '{C.TOTAL_TITLE}', sum(price), sum(sessions), 0 FROM sums GROUP BY yyyymm) WHERE rank <= 30""",
    "sized": """SELECT yyyymm, application, rank, sessions, CASE mb % 3 WHEN 0 THEN mb || ' MB' WHEN 1 THEN (mb // 1024) || ' GB'
        ELSE (mb // 1048576) || '.' || lpad(((mb * 10000) // 1048576 % 10000)::VARCHAR, 4, '0') || ' TB' END AS size FROM monthly""",
    "in_mb": """SELECT *, split_part(size, ' ', 1)::DOUBLE * CASE split_part(size, ' ', 2) WHEN 'MB' THEN 1.0 WHEN 'GB' THEN 1024.0
        WHEN 'TB' THEN 1048576.0 END AS mb FROM sized""",
    "calendar": """SELECT yyyymm, y || '年' || m || '月' AS targetYm, 'reviewer ' || m AS name,
        CASE WHEN m = 12 THEN CASE y::INT % 3 WHEN 0 THEN '2/30' WHEN 1 THEN '13/1' ELSE '2/x' END
        WHEN m % 5 <> 0 THEN (m % 12 + 1) || '/' || (m + 7) END AS eventDate, y, m FROM months""",
    "trend_mb": f"""SELECT CASE WHEN yyyymm >= '{XML_SINCE}' AND rank % 10 = 9 THEN NULL ELSE application END AS application, yyyymm, size, mb FROM in_mb""",
    "missing": """SELECT yyyymm, targetYm, name, eventDate, y::VARCHAR AS year, nullif(split_part(eventDate, '/', 1), '') AS eventMonth,
        nullif(split_part(eventDate, '/', 2), '') AS eventDay FROM calendar WHERE m % 3 = 0""",
    "enriched_people": f"""SELECT p.report, p.table_name, p.place, p.kind, p.cell, p.c_name, i.ip IS NOT NULL AS hit,
        i.hostName, i."user", i.description, i.macAddress,
        CASE WHEN kind IN (0, 1) THEN {extract('cell', IP)} END AS key FROM people p LEFT JOIN identities i
        ON i.ip = CASE WHEN kind IN (0, 1) THEN {extract('cell', IP)} WHEN kind < 7 THEN cell END""",
    "terminals": f"""SELECT report, table_name, cell, min(place) AS place, hostName, "user", description, macAddress
        FROM enriched_people WHERE kind IN (5, 6) GROUP BY ALL""",
    "enriched_visits": """SELECT v.*, d.hostName AS destinationHost, i.hostName, i."user", i.description, i.macAddress
        FROM visits v LEFT JOIN identities d ON v.domain = d.ip LEFT JOIN identities i ON v.src = i.ip""",
    "output": f"""SELECT report, table_name, place, CASE kind WHEN 0 THEN 'Login_Interface' WHEN 1 THEN 'Login_Source'
          WHEN 2 THEN 'User_or_IP_' WHEN 3 THEN 'User__or_IP_' WHEN 4 THEN 'Device2' ELSE 'Filter_name' END AS column_name,
          cell AS value, kind, hostName, "user", description, macAddress, c_name, key
          FROM enriched_people WHERE kind NOT IN (5, 6) AND (kind <> 7 OR cell <> 'srcip')""",
}


def with_parts(sql: str) -> str:
    """Prefix the query with the shared parts it uses."""
    used, text = [], sql
    for name in reversed(PARTS):
        if re.search(rf"\b{name}\b", text):
            used.append(name)
            text += " " + PARTS[name]
    head = ", ".join(f"{name} AS ({PARTS[name]})" for name in reversed(used))
    return f"WITH {head} {sql}" if head else sql


def union(*selects: str) -> str:
    return " UNION ALL ".join(selects)


def cells_of(source: str, fixed: str, columns: dict[str, str], where: str = "true") -> str:
    return union(*[
        f"SELECT {fixed}, '{name}' AS column_name, {value} AS value FROM {source} WHERE ({where}) AND ({value}) IS NOT NULL"
        for name, value in columns.items()
    ])


IDENTITY_CELLS = {name: f'"{name}"' for name in ["hostName", "user", "description", "macAddress"]}
FIXED = "report, table_name, place"
VISITS = f"'{C.USER_REPORT}' AS report, 'top10Destinations' AS table_name, place"
DOC_HOSTS = f"'{C.BANDWIDTH_REPORT}' AS report, 'Top 30 Destination by Bandwidth and Sessions' AS table_name, place"
VISIT_CELLS = {
    "Destination": "domain", "destinationHost": "destinationHost", "ip": "src", "usage": "usage", "rank": "rank",
    "Bandwidth": "usage", "Application": "'HTTPS'", **IDENTITY_CELLS,
}
assert set(VISIT_CELLS) <= set(DESTINATION_COLUMNS)
WEEKDAY = "CASE isodow({}) " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(C.WEEKDAYS, 1)) + " END"
EVENT = "try_cast(year || '-' || lpad(eventMonth, 2, '0') || '-' || lpad(eventDay, 2, '0') AS DATE)"
LAST_NAME = APPROVER.split(" ")[0]

DAY = f"coalesce(eventMonth, ' ') || '月' || coalesce(eventDay, ' ')"
REVIEW_LINES = [
    "'様式番号:ISF27-8<br><br>  '", "'# UTMレポートレビュー記録  '", f"'承認:{LAST_NAME}<br>'", f"'確認:{LAST_NAME}<br>'",
    f"'作成:{CREATOR}<br>'", "'## 実施日時'",
    f"year || '年' || {DAY} || '日（' || coalesce({WEEKDAY.format(EVENT)}, '') || '）13:30〜14:00'",
    "'## 参加者'", f"'{APPROVER}、{PARTICIPANTS}'", "'## 対象期間'", "substr(yyyymm, 1, 4) || '年' || substr(yyyymm, 5) || '月'",
    "'## 問題点'", "'定型の手順に沿って確認、対応を実施した。特記すべき問題点は存在しなかった。'", "'## 改善点・対応策'", "'特になし。'",
    "'## 今後の対応課題・対応中の課題'", "'特になし'", "'## 責任者確認'", f"year || '年' || {DAY} || '日　{LAST_NAME}'",
]


def vpn_sql(order: str) -> str:
    return f"""SELECT DISTINCT w[9] AS ip, coalesce(x10, nx) AS "user" FROM (
        SELECT w, x10, lead(x10) OVER (ORDER BY {order}) AS nx FROM (SELECT *, w[10] AS x10 FROM vpn_words WHERE event_type IN ('click', 'view')))
        WHERE w[7] = 'connected'"""


def suffix_sql(test: str) -> str:
    return f"""SELECT d.ip, arg_min(a.hostName, a.ip) AS hostName FROM (SELECT DISTINCT domain AS ip FROM page_domains) d
        LEFT JOIN (SELECT ip, arg_min(hostName, pos) AS hostName FROM allowed GROUP BY ip) a ON {test} GROUP BY d.ip"""


TREND = f"""SELECT application, size, mb AS bandwidth, yyyymm, (CASE WHEN application = '{C.TOTAL_TITLE}' THEN 99
    ELSE count(*) OVER (PARTITION BY application) END)::INTEGER AS "applicationsRank" FROM trend_mb"""
# The thirteen months up to TREND_PERIOD, written out.
TREND_MONTHS = (
    "'199807', '199808', '199809', '199810', '199811', '199812', '199901', '199902', '199903', '199904', '199905', '199906', '199907'"
)
LISTED = ", ".join(f"'{a}'" for a in [C.TOTAL_TITLE, *C.CHART_APPLICATIONS])

SQL = {
    "extract_ips": f"""SELECT doc_id, {extract('text', IP)} AS ip, nullif(regexp_extract(text, '({IP})\\n?$', 1), '') AS ip_at_end
        FROM documents WHERE regexp_matches(text, '{IP}')""",
    "extract_domains": "SELECT domain, count(*) AS pages FROM page_domains GROUP BY domain",
    "report_keys": "SELECT ip FROM found_keys",
    "report_keys_anywhere": f"""SELECT * FROM (SELECT {extract('cell', IP)} AS ip FROM cells UNION
        SELECT {extract('cell', DOMAIN)} FROM cells) WHERE ip IS NOT NULL""",
    "ip_number_roundtrip": f"""SELECT c_custkey, {ip10('c_custkey * 16')} AS ip, {TEN} + c_custkey * 16 % 16777216 AS number,
        {ip10('c_custkey * 16')} AS back, '10' AS octet FROM customer""",
    "network_bounds": """SELECT "User", head || tail AS cidr, CASE WHEN NOT bad THEN low END AS lo,
        CASE WHEN NOT bad THEN low + (1::BIGINT << (32 - bits)) - 1 END AS hi FROM networks""",
    "malformed_networks": 'SELECT "User", head || tail AS cidr FROM networks WHERE bad',
    "range_expand": f"SELECT interface, {ip_of('n')} AS ip FROM (SELECT interface, unnest(range(lo, hi + 1)) AS n FROM lans)",
    "range_lookup": f"""SELECT ip, interface FROM (SELECT DISTINCT {ip10('c_custkey')} AS ip FROM customer) JOIN lans
        ON {number('ip')} BETWEEN lo AND hi""",
    "cidr_first_match": f"""SELECT ip, arg_min("User", grp * 1000000000000 + pos) AS hostName FROM
        (SELECT DISTINCT cell AS ip FROM doc_hosts WHERE cell IS NOT NULL) JOIN good_networks
        ON {number('ip')} BETWEEN low AND high GROUP BY ip""",
    "dhcp_released": f"""SELECT ip, hostName, CASE WHEN hostName IS NOT NULL AND macAddress IS NOT NULL AND "user" IS NULL
        THEN '{C.UNREGISTERED}' ELSE "user" END AS "user", description, macAddress FROM (
        SELECT * FROM known WHERE ip NOT IN (SELECT ip FROM known_released)
        UNION ALL SELECT ip, label, label, NULL, macAddress FROM known_released)""",
    "network_override": f"""SELECT k.ip, coalesce(f.hostName, k.hostName) AS hostName, "user", description, macAddress FROM known k LEFT JOIN
        (SELECT ip, arg_min(good_networks."User", grp * 1000000000000 + good_networks.pos) AS hostName FROM known JOIN good_networks
         ON {number('ip')} BETWEEN low AND high WHERE hostName IS NULL GROUP BY ip) f ON k.ip = f.ip""",
    "domain_suffix_first_match": suffix_sql("regexp_matches(d.ip, '(?:' || a.ip || ')$')"),
    "domain_suffix_literal": suffix_sql("ends_with(d.ip, a.ip)"),
    "host_prefix_first_match": 'SELECT key AS host, m.u AS "user", m.d AS description FROM prefix_matches',
    "host_prefix_literal": 'SELECT key AS host, m.u AS "user", m.d AS description FROM prefix_matches_literal',
    "domain_pattern_first_match": """SELECT domain, arg_min(owner, pos) AS owner FROM (SELECT DISTINCT domain FROM pattern_domains) d JOIN domain_patterns p
        ON CASE WHEN broken THEN ends_with(domain, pattern) ELSE regexp_matches(domain, CASE WHEN broken THEN '' ELSE pattern || '$' END) END GROUP BY domain""",
    "host_pattern_first_match": """SELECT host, arg_min("user", pos) AS "user" FROM host_patterns JOIN pattern_assets
        ON CASE WHEN broken THEN starts_with(key, host) ELSE regexp_matches(key, CASE WHEN broken THEN '' ELSE '^(?:' || host || ')' END) END GROUP BY host""",
    "invalid_patterns": "SELECT pattern FROM domain_patterns WHERE broken UNION ALL SELECT 'pc-' || s_suppkey || '[-' FROM supplier WHERE s_suppkey % 8 = 6",
    "host_owner": f"""SELECT ip, l.hostName, CASE WHEN l.hostName = '{C.BLANK_HOST}' THEN '{C.BLANK_HOST}'
        WHEN l.hostName IS NOT NULL THEN o."user" END AS "user", o.description, macAddress
        FROM leases l JOIN owners o ON l.hostName IS NOT DISTINCT FROM o.hostName""",
    "device_priority_dedupe": "SELECT * FROM first_devices",
    "device_register": "SELECT * FROM register",
    "identity": "SELECT * FROM identities",
    "config_deny_list": f"""SELECT e.file, arg_max(substr(s.line, 2), s.pos) AS ip, any_value(split_part(e.line, '"', 2)) AS hostName,
        {NULLS} AS macAddress FROM deny_lines e
        LEFT JOIN (SELECT file, max(pos) AS last FROM deny_lines GROUP BY file) z ON z.file = e.file
        LEFT JOIN deny_lines s ON s.file = e.file AND s.line LIKE 'S%' AND s.pos > e.pos AND s.pos < z.last AND NOT EXISTS
          (SELECT 1 FROM deny_lines n WHERE n.file = e.file AND n.line = 'next' AND n.pos > e.pos AND n.pos < s.pos)
        WHERE e.line LIKE 'edit "Black%' GROUP BY e.file, e.pos""",
    "config_blocked_macs": f"""SELECT 'FW-' || c_nationkey AS file, {mac('c_custkey // 2')} AS "macAddress",
        CASE WHEN c_custkey % 3 = 0 THEN 'block' END AS action, CASE WHEN c_custkey % 5 <> 0 THEN 'guest ' || c_custkey END AS description,
        'port' || port AS "interFace" FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_custkey // 2 ORDER BY c_custkey DESC) AS rn
        FROM interfaces) WHERE rn = 1""",
    "config_dhcp_ranges": f"""SELECT 'FW-' || c_nationkey AS file, 'port' || port AS interface, {TEN} + c_custkey * 16 AS lo,
        {TEN} + c_custkey * 16 + 9 AS hi FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey, port ORDER BY c_custkey DESC) AS rn
        FROM interfaces WHERE port IS NOT NULL) WHERE rn = 1""",
    "config_blocked_macs_per_entry": f"""SELECT 'FW-' || c_nationkey AS file, {mac('c_custkey // 2')} AS "macAddress", 'block' AS action,
        CASE WHEN c_custkey % 5 = 0 THEN 'vendor ' ELSE 'guest ' END || c_custkey AS description, 'port' || port AS "interFace" FROM (SELECT *,
        row_number() OVER (PARTITION BY c_nationkey, c_custkey // 2 ORDER BY c_custkey DESC) AS rn FROM interfaces WHERE c_custkey % 3 = 0) WHERE rn = 1""",
    "config_dhcp_all_ranges": f"""SELECT 'FW-' || c_nationkey AS file, 'port' || port AS interface, {TEN} + c_custkey * 16 AS lo,
        {TEN} + c_custkey * 16 + 9 AS hi FROM interfaces WHERE port IS NOT NULL""",
    "network_span": f"""SELECT ip, arg_min("User", pos) AS "User" FROM (SELECT DISTINCT (c_custkey * 104729 * 40503) % 4294967296 AS n,
          {ip_of('(c_custkey * 104729 * 40503) % 4294967296')} AS ip FROM customer) i
        JOIN (SELECT 'wide-' || n_nationkey AS "User", ((n_nationkey // 2) % 13) * 16 * 16777216::BIGINT AS lo,
          CASE n_nationkey % 2 WHEN 0 THEN 268435456 ELSE 67108864 END AS size, (n_nationkey * 7) % 25 AS pos FROM nation) w
        ON i.n BETWEEN lo AND lo + size - 1 GROUP BY ip""",
    "plain_device_enrichment": f"""SELECT CASE WHEN c_custkey % 3 = 2 THEN '{C.BANDWIDTH_REPORT}' ELSE '{C.CLIENT_REPUTATION}' END AS report,
        CASE c_custkey % 3 WHEN 0 THEN 'レピュテーションスコアの大きい上位デバイス' WHEN 1 THEN ' 直近2期間にスコアが増加した上位ユーザー'
          ELSE 'Top 30 Destination by Bandwidth and Sessions' END AS table_name, c_custkey AS place, column_name, value FROM (
        SELECT c_custkey, unnest([CASE c_custkey % 3 WHEN 0 THEN 'Device' WHEN 1 THEN 'User__or_IP_' ELSE 'Hostname_or_IP_' END, 'hostName']) AS column_name,
          unnest([{ip10('c_custkey')}, (SELECT o.c_name FROM customer o WHERE o.c_custkey * 2 = c.c_custkey)]) AS value FROM customer c) WHERE value IS NOT NULL""",
    "lease_layout": f"""SELECT {ip10('c_custkey')} AS ip, {mac('c_custkey')} AS "macAddress",
        CASE WHEN c_nationkey % 3 = 0 THEN CASE WHEN coalesce({HOST}, '') = '' THEN '{C.BLANK_HOST}' ELSE {HOST} END
        ELSE nullif({HOST}, '') END AS hostName FROM customer WHERE c_custkey % 17 <> 0 AND c_nationkey % 3 < 2""",
    "vpn_sessions": vpn_sql("w[2], f, event_id"),
    "vpn_sessions_chronological": vpn_sql("w[2]::INT, w[3], f, event_id"),
    "vpn_local_ips": "SELECT DISTINCT replace(w[11], ')', '') AS ip FROM vpn_words WHERE event_type = 'signup'",
    "xml_tables": union(
        cells_of("customer", "'Users ' || c_nationkey AS table_name, c_custkey, 0 AS row", {
            "Dev": "CASE WHEN c_custkey % 2 = 1 THEN 'a-' || c_custkey END",
            "Dev1": "CASE WHEN c_custkey % 2 = 0 THEN 'a-' || c_custkey END",
            "Dev2": "CASE WHEN c_custkey % 2 = 0 THEN 'b & ' || c_custkey END",
            "IP": ip10("c_custkey"), "Note": "''",
        }, "c_custkey % 10 <> 0"),
        cells_of("customer", "'Users ' || c_nationkey AS table_name, c_custkey, 1 AS row", {"Dev": "'c-' || c_custkey"}, "c_custkey % 10 <> 0"),
        cells_of("customer", "'Traffic Summary' AS table_name, c_custkey, 0 AS row",
                 {"Total": "c_custkey::VARCHAR", "Unit": "'MB'"}, "c_custkey % 10 = 0"),
    ),
    "xml_user_sections": union(
        cells_of("page_domains", "'trafficSummary' AS table_name, page_id, 0 AS row", {"Total": "page_id::VARCHAR"}),
        *[cells_of("page_domains", f"'top10Destinations' AS table_name, page_id, {row} AS row", {
            **cells, "rank": f"(page_id % 5 + 1) || ': ' || {ip10('page_id')} || ' u Usage: ' || page_id % 90 || ' MB'",
        }) for row, cells in [(0, {"Destination": "domain"}), (1, {"Destination": ip10("page_id * 3"), "Hits": "(page_id % 7)::VARCHAR"})]],
    ),
    "report_enrichment": union(
        f"SELECT {FIXED}, column_name, value FROM output WHERE value IS NOT NULL AND kind <> 7",
        f"SELECT {FIXED}, column_name, value FROM output WHERE kind = 7",
        cells_of("output", FIXED, {"ip": "key"}, "kind IN (0, 1)"),
        cells_of("output", FIXED, {"Device1": "c_name"}, "kind = 4"),
        cells_of("output", FIXED, IDENTITY_CELLS, "kind < 5"),
        cells_of("terminals", FIXED, {"User_or_IP_": "cell", **IDENTITY_CELLS}),
        cells_of("(SELECT * FROM doc_hosts LEFT JOIN identities ON cell = ip)", DOC_HOSTS,
                 {"Hostname_or_IP_": "cell", "Lang": "lang", **IDENTITY_CELLS}),
        cells_of("enriched_visits", VISITS, VISIT_CELLS),
    ),
    "distinct_terminals": "SELECT report, min(place) AS place, cell AS ip FROM people WHERE kind IN (5, 6) GROUP BY report, cell",
    "drop_null_columns": "SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_orderstatus END AS sometimes FROM orders",
    "section_keys": "SELECT place, src AS ip, usage, rank FROM visits",
    "csv_section": """SELECT yyyymm AS file, rank::INTEGER AS row_no, rank::VARCHAR AS position, application, size, sessions::VARCHAR AS sessions
        FROM sized WHERE rank > 0""",
    "size_to_mb": """SELECT yyyymm, application, CASE WHEN application = 'SSH' THEN translate(size, 'MGT', 'KKK') ELSE size END AS size,
        CASE WHEN application <> 'SSH' THEN mb END AS mb FROM in_mb""",
    "bandwidth_trend": f"SELECT * FROM ({TREND} WHERE yyyymm IN ({TREND_MONTHS}))",
    "bandwidth_trend_all": TREND,
    "chart_series": f"""SELECT application, yyyymm, round(mb / 1024, 6) AS bandwidth FROM trend_mb WHERE application IN ({LISTED})
        UNION ALL SELECT 'others', yyyymm, round(sum(mb / 1024), 6) FROM trend_mb WHERE coalesce(application NOT IN ({LISTED}), true) GROUP BY yyyymm""",
    "fiscal_year": """SELECT (year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END)::INTEGER AS fiscal_year,
        count(*) AS orders FROM orders GROUP BY 1""",
    "review_calendar_of_year": f"""SELECT targetYm AS "targetYm", name, eventDate AS "eventDate", {TODAY.year}::INTEGER AS "fiscalYear" FROM calendar
        WHERE y - CASE WHEN m < 4 THEN 1 ELSE 0 END = {TODAY.year if TODAY.month >= 4 else TODAY.year - 1}""",
    "missing_periods": "SELECT * FROM missing",
    "review_text": f"SELECT yyyymm, concat_ws(chr(10), {', '.join(REVIEW_LINES)}) AS text FROM missing",
    "month_arithmetic": f"""SELECT strftime(d, '%Y%m') AS yyyymm, orders, strftime(d - INTERVAL 1 MONTH, '%Y%m') AS previous,
        strftime(d + INTERVAL 1 MONTH, '%Y%m') AS next, d BETWEEN DATE '{TREND_PERIOD[:4]}-{TREND_PERIOD[4:]}-01' - INTERVAL 12 MONTH
        AND DATE '{TREND_PERIOD[:4]}-{TREND_PERIOD[4:]}-01' AS in_window
        FROM (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS orders FROM orders GROUP BY 1)""",
    "weekdays": f"""SELECT {WEEKDAY.format("try_cast(year(o_orderdate) || '-' || lpad(month(o_orderdate)::VARCHAR, 2, '0') || '-' || (day(o_orderdate) + o_orderkey % 2) AS DATE)")}
        AS weekday, count(*) AS orders FROM orders GROUP BY 1""",
    "month_numbers": "SELECT month(o_orderdate)::INTEGER AS month, count(*) AS orders FROM orders GROUP BY 1",
    "valid_registrations": f"""SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O'
        OR o_orderdate::DATE >= DATE '{TODAY}'""",
    "mac_search": """SELECT m.mac, s.file, s.line FROM (SELECT 'switch-' || event_type AS file, 'vlan-' || event_id % 9 || ' ' || substr(d, 1, 6)
          || CASE WHEN event_type = 'error' THEN '' ELSE '-' END || substr(d, 7, 6) || '-000001 up' AS line
          FROM (SELECT *, lpad(user_id::VARCHAR, 12, '0') AS d FROM events)) s
        JOIN (SELECT substr(d, 1, 6) || '-' || substr(d, 7, 6) AS mac FROM (SELECT lpad(c_custkey::VARCHAR, 12, '0') AS d FROM customer)) m
        ON contains(s.line, m.mac)""",
    "deny_export": 'SELECT ip AS "IP", hostName AS "Description" FROM denied',
}

# Subnets of the deny list as ranges, by their texts.
SQL["deny_networks"] = f"""SELECT hostName AS "hostName", {number("split_part(ip, ' ', 1)")} AS lo,
    {number("split_part(ip, ' ', 1)")} + CASE WHEN split_part(ip, ' ', 2) = '' THEN 1 ELSE 4294967296 - {number("split_part(ip, ' ', 2)")} END - 1 AS hi
    FROM ({SQL["config_deny_list"]}) WHERE regexp_matches(split_part(ip, ' ', 1), '^{IP}$')"""

ORACLE = {name: with_parts(sql) for name, sql in SQL.items()}
