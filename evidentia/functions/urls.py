"""URL normalisation, archive addresses and links, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track, in any case, besides all that open with utm_; a bare `ref` stays.
TRACKING = ["fbclid", "gclid", "gbraid", "wbraid", "msclkid", "mc_eid", "mc_cid", "igshid", "ref_src", "ref_url", "spm", "yclid", "_ga", "_gl"]
#: Ports that a scheme implies.
DEFAULT_PORTS = {"http": "80", "https": "443"}
#: Fixed value: the address of an archived capture; group 1 is its timestamp.
ARCHIVE = r"(?i)^https?://web\.archive\.org/web/(\d{8,14})(?:id_)?/"

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"


def _tracks(name: Column) -> Column:
    return name.isin(TRACKING) | (name.startswith("utm_") & (F.length(name) > 4) & ~name.rlike("[^a-z_]"))


def normalize(url: Column) -> Column:
    """One spelling per page: https where no scheme is given, scheme and host lower, default port, fragment and
    tracking parameters dropped, the other parameters sorted, no trailing slash but on the root. Blank gives null."""
    trimmed = F.trim(url)
    full = F.when(trimmed.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), trimmed).otherwise(F.concat(F.lit("https://"), F.regexp_replace(trimmed, "^//", "")))
    part = lambda k: F.regexp_extract(full, _URL, k)
    scheme, place = F.lower(part(1)), part(2)
    user = F.regexp_extract(place, r"^(.*@)", 1)
    host = F.lower(F.regexp_replace(place, r"^.*@", ""))
    for name, port in DEFAULT_PORTS.items():
        host = F.when(scheme == name, F.regexp_replace(host, f":{port}$", "")).otherwise(host)
    kept = F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~_tracks(F.lower(F.split_part(p, F.lit("="), F.lit(1))))))
    query = F.array_join(kept, "&")
    path = F.when(part(3).isin("", "/"), "/").otherwise(F.regexp_replace(part(3), r"/+$", ""))
    return F.when(trimmed != "", F.concat(scheme, F.lit("://"), user, host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def extension(url: Column) -> Column:
    """Extension of the last path segment, one to five characters, else empty."""
    return F.lower(F.regexp_extract(F.regexp_extract(url, _URL, 3), r"/[^/]*\.([A-Za-z0-9]{1,5})$", 1))


def is_archived(raw_url: Column) -> Column:
    return F.coalesce(raw_url.rlike(ARCHIVE), F.lit(False))


def capture_timestamp(raw_url: Column) -> Column:
    return F.nullif(F.regexp_extract(raw_url, ARCHIVE, 1), F.lit(""))


def capture_date(raw_url: Column) -> Column:
    stamp = capture_timestamp(raw_url)
    return F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2))


def resolve(href: Column, base: Column) -> Column:
    """An absolute http(s) address of a link, or null."""
    scheme, place = F.regexp_extract(base, _URL, 1), F.regexp_extract(base, _URL, 2)
    root = F.concat(scheme, F.lit("://"), place)
    folder = F.regexp_replace(F.regexp_extract(base, _URL, 3), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(href.rlike(r"^(?i:https?)://"), href)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, F.regexp_extract(base, _URL, 3), href))
        .otherwise(F.concat(root, folder, href))
    )


def canonical_video(url: Column) -> Column:
    """One key for the watch, short, shorts, live, embed and v forms of a video address; null for others."""
    key = F.coalesce(
        F.nullif(F.regexp_extract(url, r"^https?://(?:www\.|m\.)?youtube\.com/watch\?(?:.*&)?v=([\w-]{6,})", 1), F.lit("")),
        F.nullif(F.regexp_extract(url, r"^https?://(?:www\.|m\.)?youtube\.com/(?:shorts|live|embed|v)/([\w-]{6,})", 1), F.lit("")),
        F.nullif(F.regexp_extract(url, r"^https?://youtu\.be/([\w-]{6,})", 1), F.lit("")),
    )
    return F.when(key.isNotNull(), F.concat(F.lit("https://www.youtube.com/watch?v="), key))


def int_parameter(url: Column, name: str) -> Column:
    return F.regexp_extract(url, rf"[?&]{name}=(\d+)(?:&|#|\z)", 1).try_cast("long")


def resolution_base(url: Column, raw_url: Column) -> Column:
    """What a page's relative links resolve against.

    An archived capture resolves against the address it holds if that is the page's own but for the scheme; a raw address
    that was not redirected elsewhere serves itself; else the page's key does.
    """
    nested = F.regexp_replace(raw_url, ARCHIVE, "")
    bare = lambda u: F.regexp_replace(normalize(u), r"^https?://", "")
    own = bare(url)
    return (
        F.when(is_archived(raw_url) & (bare(nested) == own), url)
        .when(~is_archived(raw_url) & (bare(raw_url) == own), raw_url)
        .otherwise(url)
    )
