"""Record ids and web addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_BASE = "http://evidence.example.org/input/"


def content_id(source: Column, raw: Column) -> Column:
    """``source/md5`` of the raw text."""
    return F.concat(source, F.lit("/"), F.md5(raw))


def content_url(source: Column, raw: Column, base: str = URL_BASE) -> Column:
    return F.concat(F.lit(base), source, F.lit("/"), F.md5(raw))


def document_id(uri: Column) -> Column:
    return F.sha2(uri, 256)


def url_authority(url: Column) -> Column:
    """Authority with user-info and port; ``unknown`` when the url has none."""
    part = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.when(F.length(part) > 0, part).otherwise(F.lit("unknown"))


def address_host(url: Column, ip: Column) -> Column:
    """Host of a network address: the url's authority, or the ip when no url is given."""
    return F.when(url.isNotNull(), url_authority(url)).otherwise(ip)
