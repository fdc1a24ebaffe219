"""Table layouts as DDL texts: facts, daily aggregates and helper tables."""

# Relay flags stored as one boolean column each (fixed values of the document format).
FLAG_COLUMNS = {
    "Authority": "isauthority",
    "BadExit": "isbadexit",
    "BadDirectory": "isbaddirectory",
    "Exit": "isexit",
    "Fast": "isfast",
    "Guard": "isguard",
    "HSDir": "ishsdir",
    "Named": "isnamed",
    "Stable": "isstable",
    "Running": "isrunning",
    "Unnamed": "isunnamed",
    "Valid": "isvalid",
    "V2Dir": "isv2dir",
    "V3Dir": "isv3dir",
}

# Layouts of the fact tables (fixed values, in this order).
STATUSENTRY = (
    "validafter timestamp_ntz, nickname string, fingerprint string, descriptor string,"
    " published timestamp_ntz, address string, orport int, dirport int, "
    + ", ".join(f"{c} boolean" for c in FLAG_COLUMNS.values())
    + ", version string, bandwidth bigint, ports string, rawdesc binary"
)
DESCRIPTOR = (
    "descriptor string, nickname string, address string, orport int, dirport int,"
    " fingerprint string, bandwidthavg bigint, bandwidthburst bigint, bandwidthobserved bigint,"
    " platform string, published timestamp_ntz, uptime bigint, extrainfo string, rawdesc binary"
)
EXTRAINFO = (
    "extrainfo string, nickname string, fingerprint string, published timestamp_ntz, rawdesc binary"
)
BWHIST = (
    "fingerprint string, extrainfo string, intervalend timestamp_ntz,"
    " read bigint, written bigint, dirread bigint, dirwritten bigint"
)
CONSENSUS = ("validafter timestamp_ntz, rawdesc binary")
VOTE = ("validafter timestamp_ntz, dirsource string, rawdesc binary")
DIRREQ_STATS = (
    "source string, statsend timestamp_ntz, seconds bigint, country string, requests bigint"
)
UPDATES = ("date date")

# Primary keys. They are the merge keys of ``plans.keyed_tables.insert_if_absent``.
KEYS = {
    "statusentry": ["validafter", "fingerprint"],
    "descriptor": ["descriptor"],
    "extrainfo": ["extrainfo"],
    "bwhist": ["extrainfo", "intervalend"],
    "consensus": ["validafter"],
    "vote": ["validafter", "dirsource"],
    "dirreq_stats": ["source", "statsend", "seconds", "country"],
    "network_size": ["date"],
    "network_size_hour": ["validafter"],
    "relay_platforms": ["date"],
    "relay_versions": ["date", "version"],
    "total_bandwidth": ["date"],
    "total_bwhist": ["date"],
    "user_stats": ["date", "country"],
    "relay_statuses_per_day": ["date"],
    "bridge_network_size": ["date"],
    "bridge_stats": ["date", "country"],
    "timing_stats": ["date", "source"],
    "package_stats": ["date", "bundle"],
}

# The calendar date a fact belongs to; fact tables are partitioned by it on disk.
EVENT_TIME = {
    "statusentry": "validafter",
    "descriptor": "published",
    "extrainfo": "published",
    "bwhist": "intervalend",
    "consensus": "validafter",
    "vote": "validafter",
    "dirreq_stats": "statsend",
}
