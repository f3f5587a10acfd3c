"""URLs as column expressions: entity decoding, resolution of references, canonical form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generic syntax of URLs, default ports, and the named entities that occur in links.
URL_PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
DEFAULT_PORTS = {"http": "80", "https": "443"}
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
UNRESERVED = {"2D": "-", "2E": ".", "5F": "_", "7E": "~"}
# End of fixed values.

NUMERIC_ENTITY = r"&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));"


def decode_entities(text: Column) -> Column:
    """Numeric entities and the five named ones of XML; an ampersand is decoded last, and once."""
    whole = F.regexp_extract_all(text, F.lit(NUMERIC_ENTITY), F.lit(0))
    for_each = F.array_distinct(whole)

    def character(entity: Column) -> Column:
        hexadecimal = F.regexp_extract(entity, NUMERIC_ENTITY, 2)
        number = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(
            F.regexp_extract(entity, NUMERIC_ENTITY, 1)
        ).cast("int")
        # through UTF-32, so that characters beyond the first plane come out whole
        packed = F.unhex(F.lpad(F.hex(number), 8, "0"))
        return F.when((number > 0) & (number < 0x110000), F.decode(packed, "UTF-32")).otherwise(entity)

    decoded = F.when(
        F.size(whole) > 0,
        F.aggregate(for_each, text, lambda acc, e: F.replace(acc, e, character(e))),
    ).otherwise(text)
    for name, sign in ENTITIES.items():
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(sign))
    return decoded


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PATTERN, group)


def _authority(scheme: Column, authority: Column) -> Column:
    """The user as it is, the host in lower case without a last dot, no empty or default port."""
    user = F.regexp_extract(authority, r"^//(.*@)?", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(authority, r"^//(?:.*@)?(.*?)(?::[0-9]*)?$", 1)), r"\.$", "")
    port = F.regexp_extract(authority, r":([0-9]*)$", 1)
    default = F.lit("")
    for name, number in DEFAULT_PORTS.items():
        default = F.when(scheme == name, F.lit(number)).otherwise(default)
    named = F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port))
    return F.when(host != "", F.concat(user, host, named))


def _without_dots(path: Column) -> Column:
    """The path after its segments ``.`` and ``..``, from the root."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(
        segments, F.lit(""),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.regexp_replace(acc, "/[^/]*$", ""))
        .otherwise(F.concat(acc, F.lit("/"), s)),
    )
    open_end = (kept == "") | F.element_at(segments, -1).isin(".", "..")
    dotted = path.rlike(r"(^|/)\.\.?(/|$)")
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    return F.when(dotted, F.concat(kept, F.when(open_end, "/").otherwise(""))).otherwise(rooted)


def _composed(scheme: Column, authority: Column, path: Column, query: Column) -> Column:
    scheme = F.lower(scheme)
    for code, sign in UNRESERVED.items():
        path = F.regexp_replace(path, f"(?i)%{code}", sign)
    local = F.concat(_without_dots(path), query)
    url = F.concat(scheme, F.lit("://"), _authority(scheme, authority), local)
    within = (scheme == "") & (authority == "") & path.startswith("/")
    return F.when(scheme.isin(*DEFAULT_PORTS), url).when(within, local)


def canonical_url(url: Column) -> Column:
    """One form of equal web addresses, without the fragment; null for what is no http or https URL.

    A path from the root is an address within a site that isn't named.
    """
    return _composed(_part(url, 1), _part(url, 2), _part(url, 3), _part(url, 4))


def resolve_url(base: Column, reference: Column) -> Column:
    """The canonical URL that a link on the page ``base`` leads to; null if that is no web address."""
    ref = F.trim(decode_entities(reference))
    scheme, authority, path, query = (_part(ref, k) for k in range(1, 5))
    whole, own = scheme != "", authority != ""
    folder = F.regexp_extract(_part(base, 3), r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return _composed(
        F.when(whole, scheme).otherwise(_part(base, 1)),
        F.when(whole | own, authority).otherwise(_part(base, 2)),
        F.when(whole | own | path.startswith("/"), path)
        .when(path == "", _part(base, 3))
        .otherwise(F.concat(folder, path)),
        F.when(whole | own | (path != "") | (query != ""), query).otherwise(_part(base, 4)),
    )
