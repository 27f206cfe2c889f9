"""Resolution of references against an address, as RFC 3986 says (section 5.2), in columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"(?s)^[^?#]*\?([^#]*)"
_FRAGMENT = r"(?s)#(.*)$"


def _part(c: Column, pattern: str) -> Column:
    """The first group, null where the pattern doesn't match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


def without_dots(path: Column) -> Column:
    """The path without `.` and `..` segments; `..` at the root stays there."""
    rooted = F.startswith(path, F.lit("/"))
    steps = F.split(F.when(rooted, F.substr(path, F.lit(2))).otherwise(path), "/")
    none = F.array().cast("array<string>")
    walked = F.aggregate(steps, none, lambda a, s: F.when(s == ".", a).when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(s))))
    ended = F.when(F.element_at(steps, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    return F.when(path == "", F.lit("")).otherwise(F.concat(F.when(rooted, "/").otherwise(""), F.array_join(ended, "/")))


def resolved(reference: Column, base: Column) -> Column:
    """The reference as an address. Blanks at its ends and line ends and tabs in it are dropped, as pages have them by chance.

    base: an address; its fragment doesn't count. A null reference or base gives null.
    """
    r = F.regexp_replace(F.trim(reference), r"[\t\r\n]", "")
    scheme, authority, path, query, fragment = (_part(r, p) for p in (_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT))
    b_scheme, b_authority, b_path, b_query = (_part(base, p) for p in (_SCHEME, _AUTHORITY, _PATH, _QUERY))
    own = scheme.isNotNull() | authority.isNotNull()
    merged = F.when(b_authority.isNotNull() & (b_path == ""), F.concat(F.lit("/"), path)).otherwise(F.concat(F.regexp_replace(b_path, "[^/]*$", ""), path))
    to_path = F.when(own | F.startswith(path, F.lit("/")), without_dots(path)).when(path == "", b_path).otherwise(without_dots(merged))
    to_query = F.when(own | (path != "") | query.isNotNull(), query).otherwise(b_query)
    to_authority = F.when(own, authority).otherwise(b_authority)
    text = F.concat(
        F.coalesce(F.concat(F.coalesce(scheme, b_scheme), F.lit(":")), F.lit("")), F.coalesce(F.concat(F.lit("//"), to_authority), F.lit("")), to_path,
        F.coalesce(F.concat(F.lit("?"), to_query), F.lit("")), F.coalesce(F.concat(F.lit("#"), fragment), F.lit("")),
    )
    return F.when(base.isNotNull(), text)


def page_address(address: Column) -> Column:
    """An address without query, fragment and the parameters (`;...`) of its last segment."""
    return F.regexp_replace(F.regexp_replace(address, r"(?s)[?#].*$", ""), r"(?<=/[^/]{0,4096});[^/]*$", "")
