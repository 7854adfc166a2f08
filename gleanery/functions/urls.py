"""URL tests and repairs as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import collapse_space, strip_space

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def authority(url: Column) -> Column:
    """The network location as written, port and user part included; '' if there is none."""
    return F.regexp_extract(url, _AUTHORITY, 1)


def url_key(url: Column) -> Column:
    """Hex SHA-256 of the address: the identity of a capture."""
    return F.sha2(url, 256)


def is_http_url(url: Column) -> Column:
    """True for an absolute http(s) address with a network location; never null."""
    cleaned = F.regexp_replace(strip_space(url), r"^[\x00-\x20]+|[\t\r\n]", "")
    return F.coalesce(F.rlike(cleaned, F.lit(r"(?i)^https?://[^/?#]")), F.lit(False))


def _candidate(url: Column) -> Column:
    """Collapsed address with a scheme, or null when the text cannot be one."""
    text = collapse_space(url)
    bare_host = (
        ~F.contains(text, F.lit(" "))
        & (F.length(text) >= 4)
        & ~F.startswith(text, F.lit("/"))
        & F.contains(F.substring_index(text, "/", 1), F.lit("."))
    )
    return F.when(F.rlike(text, F.lit(r"(?i)^https?://")), text).when(
        bare_host, F.concat(F.lit("https://"), text)
    )


def coerce_http_url(url: Column) -> Column:
    """Absolute http(s) address (a bare host gets https), or null if not recoverable."""
    candidate = _candidate(url)
    return F.when(F.rlike(candidate, F.lit(r"(?i)^https?://[^/?#]")), candidate)


def has_broken_host(url: Column) -> Column:
    """True where the host has unbalanced or non-IPv6 brackets, so no address can be read."""
    host = authority(_candidate(url))
    bracketed = F.rlike(host, F.lit(r"[\[\]]"))
    readable = F.rlike(
        host,
        F.lit(
            r"^(?:[^\[\]]*@)?\[(?:[0-9A-Fa-f.]*:[0-9A-Fa-f.:]*:[0-9A-Fa-f.:]*(?:%[^\[\]]+)?"
            r"|[vV][0-9A-Fa-f]+\.[^\[\]]+)\](?::[^\[\]]*)?$"
        ),
    )
    return F.coalesce(bracketed & ~readable, F.lit(False))


def resolve_link(application_url: Column, source_url: Column) -> Column:
    """First recoverable of the two; otherwise the source address trimmed, '' if null."""
    return F.coalesce(
        coerce_http_url(application_url),
        coerce_http_url(source_url),
        strip_space(F.coalesce(source_url, F.lit(""))),
    )


def link_is_unreadable(application_url: Column, source_url: Column) -> Column:
    """True where resolving the link meets a broken host before it finds a good one."""
    application = coerce_http_url(application_url).isNotNull()
    return has_broken_host(application_url) | (~application & has_broken_host(source_url))
