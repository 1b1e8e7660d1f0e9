"""URL functions, Column in and Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an archived URL begins with, and how much of it is dropped: the prefix, a 14-digit stamp, slashes.
ARCHIVE_PREFIX, ARCHIVE_LENGTH = "https://web.archive.org/web", 43

# Hosts and file extensions that can't be scraped for text.
BLOCKED_HOSTS = ["books.google.com", "books.google.co.in", "youtube.com"]
BLOCKED_EXTENSIONS = [".pdf", ".jpeg", ".jpg", ".png", ".mp3", ".mp4", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx"]


def unwrap_archive(url: Column) -> Column:
    """The archived URL behind an archive wrapper of fixed length; other URLs as they are."""
    return F.when(url.startswith(ARCHIVE_PREFIX), F.substring(url, F.lit(ARCHIVE_LENGTH + 1), F.length(url))).otherwise(url)


def authority(url: Column) -> Column:
    """Host and port of a URL with a scheme; empty otherwise."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Path of a URL with a scheme; empty otherwise."""
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def is_scrapable(url: Column) -> Column:
    """Whether a URL's host isn't blocked (exactly, behind an optional www.) and its extension isn't
    (case-sensitive). False for null and for what has no host."""
    host = F.regexp_replace(authority(url), r"^www\.", "")
    extension = F.regexp_extract(path(url), r"(\.[^./]*)$", 1)
    return F.coalesce((host != "") & ~host.isin(BLOCKED_HOSTS) & ~extension.isin(BLOCKED_EXTENSIONS), F.lit(False))


def canonical_key(url: Column) -> Column:
    """Sort-friendly key of a URL: host labels reversed by commas, ``)``, path and query; lower case,
    without scheme, user, www prefix, default port, fragment and trailing slashes; arguments sorted.
    Null for null and for what has no host."""
    low = F.lower(F.trim(url))
    bare = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^[^@]*@", ""), r":(80|443)$", ""), r"^www\d*\.", "")
    place = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    arguments = F.when(query != "", F.concat(F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&"))).otherwise("")
    return F.when(host != "", F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(place == "", "/").otherwise(place), arguments))


def tidy_key(key: Column) -> Column:
    """A canonical key without fragment, tracking query and trailing slashes, in lower case."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(key), r"#.*$", ""), r"\?utm_.*$", ""), r"/+$", "")


def byte_range(offset: Column, length: Column) -> Column:
    """The value of a range request for ``length`` bytes from ``offset``."""
    return F.concat(F.lit("bytes="), offset.cast("string"), F.lit("-"), (offset + length - 1).cast("string"))


def effective_url(canonical_link: Column, url: Column) -> Column:
    """The link by which a document calls itself, else the URL that cites it."""
    return F.coalesce(F.nullif(canonical_link, F.lit("")), url)
