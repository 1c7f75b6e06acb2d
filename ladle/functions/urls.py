"""URL parts, identity and resolution as Column expressions (RFC 3986, http family)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.binding import let

# The splitting pattern of RFC 3986, appendix B: scheme, authority, path, query, fragment.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#(?s:.*))?$"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*:"

# Default port per scheme.
_DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}


def _parts(url: Column) -> Column:
    names = ("scheme", "authority", "path", "query", "fragment")
    return F.struct(*[F.regexp_extract(url, _PARTS, i + 1).alias(n) for i, n in enumerate(names)])


def _host(authority: Column) -> Column:
    return F.lower(F.regexp_replace(authority, r"^.*@|:\d*$", ""))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def host(url: Column) -> Column:
    """Host name without user-info and port, lower case."""
    return _host(F.regexp_extract(url, _PARTS, 2))


def path(url: Column) -> Column:
    """Absolute path; '/' when the URL names only a host."""
    return F.coalesce(F.nullif(F.regexp_extract(url, _PARTS, 3), F.lit("")), F.lit("/"))


def is_absolute(url: Column) -> Column:
    """Any scheme counts, `mailto:` included."""
    return F.coalesce(url.rlike(_ABSOLUTE), F.lit(False))


def _site(p: Column) -> Column:
    """Scheme and authority: host in lower case, default port dropped, user-info kept."""
    port = F.regexp_extract(p["authority"], r":(\d+)$", 1)
    low = F.lower(p["scheme"])
    usual = F.lit(False)
    for name, number in _DEFAULT_PORTS.items():
        usual = usual | ((low == name) & (port == number))
    return F.concat(low, F.lit("://"), F.regexp_extract(p["authority"], r"^(.*@)", 1),
                    _host(p["authority"]),
                    F.when((port == "") | usual, F.lit("")).otherwise(F.concat(F.lit(":"), port)))


def _canonical(p: Column, fragment: Column) -> Column:
    slash = F.when(p["path"].startswith("/"), F.lit("")).otherwise(F.lit("/"))
    tail = F.concat(p["query"], fragment)
    return (F.when((p["scheme"] != "") & (p["authority"] != ""),
                   F.concat(_site(p), slash, p["path"], tail))
             .when(p["scheme"] != "", F.concat(F.lower(p["scheme"]), F.lit(":"), p["path"], tail))
             .otherwise(F.concat(p["path"], tail)))


def url_key(url: Column) -> Column:
    """Identity of a URL: scheme and host in lower case, default port and fragment dropped."""
    return let(_parts(url), lambda p: _canonical(p, F.lit("")))


def absolute(url: Column) -> Column:
    """Canonical spelling of a URL, its fragment kept."""
    return let(_parts(url), lambda p: _canonical(p, p["fragment"]))


def resolve(base: Column, ref: Column) -> Column:
    """Absolute form of `ref` seen on the page `base` (RFC 3986, section 5)."""
    bare = F.regexp_replace(ref, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    both = F.struct(_parts(base).alias("b"), bare.alias("ref"), _parts(bare).alias("r"))
    return let(both, _resolved)


def _resolved(v: Column) -> Column:
    b, r = v["b"], v["r"]
    root = F.concat(F.lower(b["scheme"]), F.lit("://"), b["authority"])
    folder = F.regexp_replace(F.when(b["path"] == "", F.lit("/")).otherwise(b["path"]), r"[^/]*$", "")
    page = F.when(b["path"] == "", F.lit("/")).otherwise(b["path"])
    tail = F.concat(r["query"], r["fragment"])
    return (
        F.when((r["scheme"] != "") & (r["authority"] == ""), v["ref"])
         .when(r["scheme"] != "", F.concat(r["scheme"], F.lit("://"), r["authority"],
                                           _without_dots(r["path"]), tail))
         .when(v["ref"].startswith("//"), F.concat(F.lower(b["scheme"]), F.lit("://"), r["authority"],
                                                   _without_dots(r["path"]), tail))
         .when(r["path"].startswith("/"), F.concat(root, _without_dots(r["path"]), tail))
         .when(r["path"] != "", F.concat(root, _without_dots(F.concat(folder, r["path"])), tail))
         .when(r["query"] != "", F.concat(root, page, tail))
         .otherwise(F.concat(root, page, b["query"], r["fragment"]))
    )


def _without_dots(where: Column) -> Column:
    """Remove `.` and `..` segments; a path without any is left as it is."""
    # One left fold over the segments: `..` drops the last kept one, `.` adds none. The fold
    # starts after the leading slash; a last segment that is a dot names its folder.
    def fold(w: Column) -> Column:
        kept = F.aggregate(
            F.slice(F.split(w, "/"), 2, F.greatest(F.size(F.split(w, "/")) - 1, F.lit(0))),
            F.array().cast("array<string>"),
            lambda seen, s: F.when(s == "..", F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(0))))
                             .when(s == ".", seen)
                             .otherwise(F.concat(seen, F.array(s))))
        folder = F.when(w.rlike(r"/\.{1,2}$") & ~w.rlike(r"^/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
        return F.regexp_replace(F.concat(F.lit("/"), F.array_join(kept, "/"), folder), "^/+$", "/")
    return let(where, lambda w: F.when(w.rlike(r"/\.{1,2}(/|$)"), fold(w)).otherwise(w))


def recipe_url(prefix: str, recipe_id: Column) -> Column:
    return F.concat(F.lit(prefix), recipe_id.cast("string"))


def document_id(url: Column, recipe_id: Column) -> Column:
    return F.concat(host(url), F.lit("-"), recipe_id.cast("string"))


def store_key(url: Column) -> Column:
    """Object key of a stored page: absolute form, '/', absolute path."""
    return F.concat(absolute(url), F.lit("/"), path(url))
