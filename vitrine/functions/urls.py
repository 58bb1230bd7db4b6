"""URL parts.

Patterns instead of parse_url: click logs hold unescaped characters (spaces, pipes, umlauts) that
a strict URI parser rejects, which would lose the host of such rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from vitrine.functions.text import blank_to_null

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def url_host(url: Column) -> Column:
    return blank_to_null(F.lower(F.regexp_extract(url, HOST, 1)))


def url_country(url: Column) -> Column:
    """Country of a shop URL: the last label of its host (`de`, `fr`, ... `com`)."""
    return blank_to_null(F.regexp_extract(url_host(url), r"\.([a-z]+)$", 1))


def url_parameter(url: Column, name: str) -> Column:
    """First value of a query parameter, percent-decoded; NULL when it is absent or empty."""
    pattern = rf"^[^#?]*\?(?:[^#]*?&)?{re.escape(name)}=([^&#]*)"
    raw = F.regexp_extract(url, pattern, 1)
    return blank_to_null(F.coalesce(F.try_url_decode(raw), raw))
