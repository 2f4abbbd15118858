"""Small lookup tables of the registered queries, as VALUES text for both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A few registered ports, with spacing and case to be normalised.
PORTS = "(values (22, 'SSH'), (53, 'Domain Name'), (80, 'HTTP'), (443, 'HTTPS over TLS'), (5000, 'Commplex  Main')) as ports(port, service)"
# Two ICMP messages per IP version.
ICMP = (
    "(values ('ipv4', 8, 0, 'Echo', 'No Code'), ('ipv4', 0, 0, 'Echo Reply', 'No Code'),"
    " ('ipv6', 128, 0, 'Echo Request', 'No Code'), ('ipv6', 129, 0, 'Echo Reply', 'No Code'))"
    " as icmp(ip_version, type, code, type_name, code_name)"
)
# Short descriptions of our own; the id 103 is listed twice, the last one counts.
EVENTS = (
    "(values (100, 'first sight', 1), (101, 'button pressed', 2), (103, 'old text', 3),"
    " (103, 'purchase made', 4), (104, 'failure', 5)) as event_names(event_id, description, rank)"
)
# An invented naming convention for accounts and machines.
NAME_CODES = "(values ('SUPPLIER', 'delivers goods'), ('CUSTOMER', 'buys goods')) as name_codes(code, description)"
NAME_PATTERN = r"(SUPPLIER|CUSTOMER|PARTNER)#([0-9]{3})([0-9]+)"
# Domain suffix rules, with an invented wildcard and exception.
SUFFIXES = (
    "(values ('com', 'exact'), ('net', 'exact'), ('org', 'exact'), ('example.org', 'exact'),"
    " ('example.net', 'wildcard'), ('ththan.example.net', 'exception')) as suffixes(suffix, rule)"
)


def dim(spark: SparkSession, values: str) -> DataFrame:
    return spark.sql(f"select * from {values}")
