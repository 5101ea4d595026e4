"""Fixed values. Inputs and results carry these texts, so they are stated as they are."""

# Names of the seven firewall reports.
ADMIN_EVENTS = "Admin and System Events Report"
BANDWIDTH_REPORT = "Bandwidth and Applications Report without guest"
CLIENT_REPUTATION = "Client Reputation without guest"
TERMINALS_DATACENTER = "List of terminals connected to DataCenter"
TERMINALS_CENTER = "List of terminals connected to nmccrc"
TERMINALS_VPN = "List of terminals connected vpn"
USER_REPORT = "User Report without guest"
REPORT_NAMES = [
    ADMIN_EVENTS,
    BANDWIDTH_REPORT,
    CLIENT_REPUTATION,
    TERMINALS_DATACENTER,
    TERMINALS_CENTER,
    TERMINALS_VPN,
    USER_REPORT,
]

# Table and section names inside the reports.
TRAFFIC_SUMMARY = "Traffic Summary"
TRAFFIC_STATISTICS = "Traffic Statistics"
TOP_DESTINATIONS = "Top 10 Destinations"
TOP_APPLICATIONS = "Top 30 Applications by Bandwidth and Sessions"
USER_SECTION = "Top_5_Users_by_Bandwidth"
TOTAL_TITLE = "Total Bytes Transferred"
TERMINAL_TABLE = "Top 100 Users by Bandwidth and Sessions"
REPORT_FILTERS = "Report Filters(Logic: All)"

# Labels written into the identity columns.
BLANK_HOST = "DHCPログのホスト名が空白のため詳細確認不可能"
RELEASED = "DHCPリリース済みのため詳細確認不可"
UNREGISTERED = "! SINET未登録端末"
VPN_HOST = "VPN接続"
VPN_LOCAL_HOST = "vpn user"
DHCP_MARKERS = ["DHCP Start", "DHCP End"]

# Applications drawn one by one in the chart; the others are summed.
CHART_APPLICATIONS = [
    "IKE", "SSH", "HTTPS", "HTTP", "udp/19305", "udp/443", "udp/8801", "tcp/8052",
]

# Calendar words.
MONTH_ABBREVIATIONS = [
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
]
WEEKDAYS = ["月", "火", "水", "木", "金", "土", "日"]

# First period whose bandwidth report is XML; earlier ones are sectioned CSV.
XML_SINCE = "202411"
