"""URL parts, absolute and canonical forms: row-local column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentweave.functions.text import bind

UNKNOWN_ID = "999999999"


def domain_of(url: Column) -> Column:
    """Scheme and host."""
    return F.regexp_extract(url, "^(https?://[^/?#]*)", 1)


def directory_of(url: Column) -> Column:
    """Scheme, host and path up to the last slash, with it."""
    path = F.regexp_extract(url, "^(https?://[^?#]*)", 1)
    return F.when(path.rlike("^https?://[^/]*$"), F.concat(path, F.lit("/"))).otherwise(F.regexp_replace(path, "[^/]*$", ""))


def file_of(url: Column) -> Column:
    return F.regexp_extract(url, "^https?://[^/?#]*[^?#]*/([^/?#]*)", 1)


def wanted_href(href: Column) -> Column:
    """Neither mail nor script nor within the page nor an image."""
    return href.isNotNull() & (href != "") & ~href.rlike("^mail|javascript|#|\\.(jpe?g|gif|png)$")


def _clean_path(path: Column) -> Column:
    """The path without ``.``, ``..`` and empty steps; a closing slash stays."""
    steps = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", up(done)).otherwise(F.concat(done, F.array(s))))
    closing = F.when((F.size(kept) > 0) & path.rlike("/(\\.{0,2})$"), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closing)


def canonical(url: Column) -> Column:
    """The url without fragment and with a clean path; null unless it is http or https."""

    def cleaned(rest: Column) -> Column:
        path = F.regexp_extract(rest, "^([^?]*)", 1)
        return F.concat(F.when(path == "", "/").otherwise(_clean_path(path)), F.regexp_extract(rest, "(\\?.*)$", 1))

    def whole(u: Column) -> Column:
        host = F.regexp_extract(u, "^(?i)(https?)://([^/?#]+)", 0)
        rest = F.regexp_replace(F.substring(u, F.length(host) + 1, F.length(u)), "#.*$", "")
        return F.when(host != "", F.concat(F.lower(host), bind(rest, cleaned)))

    return bind(url, whole)


def absolute(base: Column, href: Column) -> Column:
    """``href`` seen from the page ``base``, canonical; control characters and blanks at its ends don't count."""
    h = F.regexp_replace(F.trim(href), "[\\x00-\\x1f\\x7f]", "")
    scheme = F.regexp_extract(base, "^(https?:)", 1)
    full = (
        F.when(h.rlike("^(?i)https?://"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(domain_of(base), h))
        .when(h.startswith("?"), F.concat(F.regexp_extract(base, "^([^?#]*)", 1), h))
        .when(h.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None).cast("string"))
        .otherwise(F.concat(directory_of(base), h))
    )
    return canonical(full)


def resolved(base: Column, href: Column) -> Column:
    """``href`` seen from ``base`` as RFC 3986 resolves references, of any scheme, fragment and all; control characters go from the result.

    An empty reference is the base without its fragment; a null base leaves the reference as it is. Unlike :func:`absolute` it makes nothing canonical.
    """
    head = "^([a-zA-Z][a-zA-Z0-9+.-]*:)"
    scheme, rest = F.regexp_extract(base, head, 1), F.regexp_replace(base, head, "")
    authority = F.regexp_extract(rest, "^(//[^/?#]*)", 1)
    path, query = F.regexp_extract(rest, "^(?://[^/?#]*)?([^?#]*)", 1), F.regexp_extract(rest, "^[^?#]*(\\?[^#]*)", 1)
    own, tail = F.regexp_extract(href, "^([^?#]*)", 1), F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    folder = F.when((authority != "") & (path == ""), "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    merged = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    found = (
        F.when(base.isNull() | href.rlike(head), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(own == "", F.concat(scheme, authority, path, F.when(tail.startswith("?"), tail).otherwise(F.concat(query, tail))))
        .otherwise(F.concat(scheme, authority, bind(merged, _without_dots), tail))
    )
    return F.regexp_replace(found, "[\\x00-\\x1f\\x7f-\\x9f]", "")


def _without_dots(path: Column) -> Column:
    """The path without ``.`` and ``..`` steps; empty steps stay, as the RFC has it."""
    rooted = path.startswith("/")
    steps = F.split(F.when(rooted, F.substring(path, F.lit(2), F.length(path))).otherwise(path), "/")
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    closing = F.when(path.rlike("(^|/)\\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.when(rooted, "/").otherwise(""), F.array_join(kept, "/"), closing)


def without_scheme(url: Column) -> Column:
    """The name that dictionaries of page ids know a url by."""
    return F.regexp_replace(url, "^https?://", "")
