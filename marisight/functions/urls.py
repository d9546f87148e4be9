"""URL, file name and storage path functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: suffixes of downloadable documents and their media types
DOCUMENT_TYPES = {
    ".pdf": "application/pdf",
    ".doc": "application/msword",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xls": "application/vnd.ms-excel",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".ppt": "application/vnd.ms-powerpoint",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".zip": "application/zip",
}
#: fixed values: suffixes of pages and their media type
PAGE_TYPES = {".html": "text/html", ".htm": "text/html"}
#: fixed values: query parameters that track a reader or a session
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term", "fbclid", "gclid", "msclkid", "sessionid", "phpsessid", "jsessionid", "_ga")

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def authority(url: Column) -> Column:
    """Lower-cased host with port, '' without one."""
    return F.lower(F.regexp_extract(F.trim(url), _AUTHORITY, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), _PATH, 1)


def query(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), _QUERY, 1)


def _with_query(base: Column, q: Column) -> Column:
    return F.when(q == "", base).otherwise(F.concat(base, F.lit("?"), q))


def canonical(url: Column) -> Column:
    """https, lower-cased host, path without ``;params`` and query as they are, no fragment; idempotent."""
    return _with_query(F.concat(F.lit("https://"), authority(url), F.regexp_replace(path(url), r";[^/]*$", "")), query(url))


def bare_host(url: Column) -> Column:
    return F.regexp_replace(authority(url), r"^www\.", "")


def canonical_compact(url: Column) -> Column:
    """Like ``canonical``; also without ``www.``, doubled or trailing slashes and utm parameters, query sorted."""
    p = F.regexp_replace(F.regexp_replace(path(url), "/{2,}", "/"), "/+$", "")
    parts = F.filter(F.split(query(url), "&"), lambda x: (x != "") & ~x.startswith("utm_"))
    return _with_query(F.concat(F.lit("https://"), bare_host(url), F.when(p == "", F.lit("/")).otherwise(p)), F.array_join(F.array_sort(parts), "&"))


def host_allowed(url: Column, hosts: Column) -> Column:
    """Whether the host, with ``www.`` taken out of both sides, is one of the given ones."""
    plain = lambda h: F.replace(F.lower(h), F.lit("www."), F.lit(""))
    return F.array_contains(F.transform(hosts, plain), plain(authority(url)))


def requoted(path: Column) -> Column:
    """A path with its percent escapes decoded and written again in one way; as it is if they are no text."""
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    quoted = F.url_encode(plain)  # as forms are: some characters differ in paths
    for form, own in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        quoted = F.replace(quoted, F.lit(form), F.lit(own))
    return quoted


def _own_parameters(url: Column) -> Column:
    """Parameters with a value that track nothing, by name; of several of one name the last."""
    parts = F.filter(F.split(query(url), "&"), lambda p: F.contains(p, F.lit("=")))
    named = F.transform(parts, lambda p, i: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("key"), i.alias("i"), p.alias("p")))
    own = F.filter(named, lambda x: ~F.lower(x["key"]).isin(*TRACKING) & ~F.exists(named, lambda y: (y["key"] == x["key"]) & (y["i"] > x["i"])))
    return F.array_join(F.transform(F.array_sort(own), lambda x: x["p"]), "&")


def canonical_allowed(url: Column, hosts: Column) -> Column:
    """Null outside the allowed hosts; lower-cased https without ``www.``, tracking parameters and fragment, the path
    re-quoted, parameters sorted, and a trailing slash cut from all but the root."""
    host = F.replace(authority(url), F.lit("www."), F.lit(""))
    whole = _with_query(F.concat(F.lit("https://"), host, requoted(F.regexp_replace(path(url), r";[^/]*$", ""))), _own_parameters(url))
    slashes = F.length(whole) - F.length(F.replace(whole, F.lit("/"), F.lit("")))
    return F.when(host_allowed(url, hosts), F.lower(F.when(slashes > 3, F.regexp_replace(whole, "/+$", "")).otherwise(whole)))


def canonical_valid(url: Column) -> Column:
    """Null unless http(s) with a host; trailing slash cut, scheme kept."""
    scheme = F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    whole = _with_query(F.concat(scheme, F.lit("://"), authority(url), F.regexp_replace(path(url), "/+$", "")), query(url))
    return F.when(scheme.isin("http", "https") & (authority(url) != ""), whole)


def is_document(url: Column) -> Column:
    return F.lower(path(url)).rlike(r"\.(pdf|docx?|xlsx?|pptx?|zip)$")


def content_type(url: Column, default: str = "application/octet-stream") -> Column:
    """Media type by suffix of the path."""
    known = F.create_map(*[F.lit(x) for pair in {**DOCUMENT_TYPES, **PAGE_TYPES}.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.regexp_extract(F.lower(path(url)), r"(\.[a-z]+)$", 1)), F.lit(default))


def file_name(url: Column, default: str = "document") -> Column:
    return F.coalesce(F.nullif(F.element_at(F.split(path(url), "/"), -1), F.lit("")), F.lit(default))


def skipped_href(href: Column) -> Column:
    return F.coalesce(href, F.lit("")).rlike(r"^(javascript:|#|mailto:)")


def same_domain(a: Column, b: Column) -> Column:
    return bare_host(a) == bare_host(b)


#: addresses from the root without dot segments
_ROOTED = r"^/(?!/)(?![^?#]*/\.)[^?#]*(?:[?#].*)?\z"


def absolute(href: Column, base: Column) -> Column:
    """href resolved against base: absolute, scheme-relative, root-relative, fragment, query and relative
    forms, with dot segments removed (a native form of RFC 3986 section 5.2 for http addresses)."""
    h = F.trim(href)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(F.trim(base), _AUTHORITY, 1))
    own, rest = F.regexp_extract(h, r"^([^?#]*)", 1), F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    joined = F.when(own.startswith("/"), own).otherwise(F.concat(F.regexp_replace(F.when(path(base) == "", F.lit("/")).otherwise(path(base)), r"[^/]*$", ""), own))
    fold = F.aggregate(
        F.slice(F.split(joined, "/"), 2, F.lit(1 << 20)),
        F.array().cast("array<string>"),
        lambda s, x: F.when(x == ".", s).when(x == "..", F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(F.concat(s, F.array(x))),
    )
    dots = joined.rlike(r"(^|/)\.{1,2}$")
    flat = F.concat(F.lit("/"), F.array_join(fold, "/"), F.when(dots & (F.size(fold) > 0), F.lit("/")).otherwise(F.lit("")))
    return (
        F.when(h.rlike(_ROOTED), F.concat(root, h))  # most links, without the fold
        .when(h == "", base)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), h))
        .when(h.startswith("?"), F.concat(root, path(base), h))
        .otherwise(F.concat(root, flat, rest))
    )


def versioned_name(name: Column, changed_on: Column) -> Column:
    """stem_date.ext when there is a date."""
    stem, ext = F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.regexp_extract(name, r"(?<=.)(\.[^.]*)$", 1)
    return F.when(changed_on.isNull(), name).otherwise(F.concat(stem, F.lit("_"), F.date_format(changed_on, "yyyy-MM-dd"), ext))


def slug(text: Column, default: str = "unknown-agency") -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", F.lit(default)).otherwise(s)


def safe_name(name: Column) -> Column:
    """Letters and digits of any script, ``_``, ``.`` and ``-`` as they are, all else as ``_``."""
    return F.regexp_replace(name, r"[^\p{L}\p{N}_.\-]", "_")


def base_name(name: Column, default: str = "document.bin") -> Column:
    return F.coalesce(F.nullif(F.element_at(F.split(F.coalesce(name, F.lit("")), "/"), -1), F.lit("")), F.lit(default))


def record_id(url: Column, digits: int = 24) -> Column:
    return F.substring(F.sha2(url.cast("binary"), 256), 1, digits)


def language_record_id(url: Column, language: Column) -> Column:
    """Sixteen digits for an address in a language."""
    return record_id(F.concat(url, F.lit("#"), language), 16)


def payload_record_id(sha256: Column, unique: Column) -> Column:
    """Sixteen digits of the content's digest and eight of a unique id, such as F.uuid() without its dashes."""
    return F.concat(F.substring(sha256, 1, 16), F.lit("-"), F.substring(F.replace(unique, F.lit("-"), F.lit("")), 1, 8))


def archive_path(agency: Column, day: Column, sha256: Column, name: Column, prefix: str = "gov-docs") -> Column:
    return F.concat_ws("/", F.lit(prefix), agency, F.lit("raw"), F.date_format(day, "yyyy/MM/dd"), F.concat_ws("_", sha256, name))


def archive_path_by_type(agency: Column, day: Column, sha256: Column, name: Column, prefix: str = "gov-docs") -> Column:
    """The digest and the name's extension, if it has one."""
    return F.concat_ws("/", F.lit(prefix), agency, F.lit("raw"), F.date_format(day, "yyyy/MM/dd"), F.concat(sha256, F.regexp_extract(F.coalesce(name, F.lit("")), r"(\.[^.]*)$", 1)))


def archive_path_by_month(folder: Column, day: Column, sha256: Column, name: Column) -> Column:
    """A month's folder, sixteen digits of the digest and the name made safe."""
    return F.concat_ws("/", folder, F.date_format(day, "yyyy-MM"), F.concat_ws("_", F.substring(sha256, 1, 16), safe_name(base_name(name))))


def legacy_path(agency: Column, day: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit("gov-my"), slug(agency), F.date_format(day, "yyyy-MM"), name)


def title_of(name: Column) -> Column:
    """File stem without a leading 16-hex mark, with ``_`` and ``-`` as spaces."""
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    return F.trim(F.translate(F.when(F.length(stem) > 17, F.regexp_replace(stem, "^[0-9a-f]{16}_", "")).otherwise(stem), "_-", "  "))


def hex_link(value: Column) -> Column:
    """A link kept as hex digits of its base64 form; anything else comes back unchanged."""
    inner = F.try_to_binary(value, F.lit("hex"))
    plain = F.decode(F.try_to_binary(F.decode(inner, "UTF-8"), F.lit("base64")), "UTF-8")
    return F.when(value.rlike("^([0-9a-fA-F]{2})+$"), F.coalesce(plain, value)).otherwise(value)
