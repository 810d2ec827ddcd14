"""Which locations may be fetched: schemes, and addresses that are no public hosts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Address blocks that are reserved for private networks, loopback, link-local and metadata services.
PRIVATE = (r"^127\.", r"^10\.", r"^192\.168\.", r"^172\.(1[6-9]|2\d|3[01])\.", r"^169\.254\.", r"^0\.", r"^100\.(6[4-9]|[7-9]\d|1[01]\d|12[0-7])\.")
LOCAL_NAMES = ("localhost", "metadata.google.internal", "metadata.tencentyun.com", "[::1]", "::1")
#: Addresses of metadata services, which stay blocked whatever else may be fetched.
METADATA = (r"^169\.254\.", r"^100\.100\.100\.200$", r"^\[fd00:ec2:")
METADATA_NAMES = ("metadata.google.internal", "metadata.tencentyun.com")


def host(url: Column) -> Column:
    """Host in lower case, or null."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def is_public(url: Column) -> Column:
    """http or https, and a host that is neither local by name nor a reserved address; false for null and what is no URL."""
    h = host(url)
    reserved = F.lit(False)
    for pattern in PRIVATE:
        reserved |= h.rlike(pattern)
    named = h.isin(*LOCAL_NAMES) | h.endswith(".local") | h.endswith(".internal") | h.startswith("[f") | h.rlike(r"^\d+$") | h.rlike(r"^0x")
    fine = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https") & h.isNotNull() & ~reserved & ~named
    return F.coalesce(fine, F.lit(False))


def plain_address(name: Column) -> Column:
    """An IPv4 address that is written within an IPv6 one, as such; other names as they are."""
    inner = F.regexp_extract(name, r"^\[(?:::ffff:|::)(\d+\.\d+\.\d+\.\d+)\]$", 1)
    return F.when(inner != "", inner).otherwise(name)


def refusal(url: Column, internal: bool = False, hosts: list[str] | None = None) -> Column:
    """Why a location must not be fetched, or null: scheme, metadata service, a host not among those allowed, or a reserved address.

    ``internal`` allows private addresses, but never metadata services. Names are not resolved here.
    """
    name = plain_address(host(url))
    scheme = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    metadata = name.isin(*METADATA_NAMES)
    for pattern in METADATA:
        metadata = metadata | name.rlike(pattern)
    out = F.when(~F.coalesce(scheme.isin("http", "https"), F.lit(False)), "scheme").when(name.isNull(), "host").when(metadata, "metadata")
    if hosts is not None:
        out = out.when(~name.isin(*hosts), "host")
    if not internal:
        out = out.when(~is_public(F.concat(F.lit("http://"), name, F.lit("/"))), "private")
    return out
