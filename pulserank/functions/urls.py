"""Column expressions over urls and identifiers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulserank.functions.text import clean, col

_AUTHORITY = "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"


def url_host(url: str | Column) -> Column:
    """Lower-case authority of a url without one leading ``www.``; null if there is none.

    User info and port stay.  An authority with an unpaired bracket counts as none.
    """
    host = F.lower(F.regexp_extract(clean(url), _AUTHORITY, 1))
    host = F.when(F.contains(host, F.lit("[")) == F.contains(host, F.lit("]")), host)
    return F.nullif(F.regexp_replace(host, "^www\\.", ""), F.lit(""))


def opportunity_id(source: str | Column, id_: str | Column, url: str | Column, title: str | Column) -> Column:
    """``source::id``, else the source with a digest of the url, else of source and title."""
    src, rid, link, head = F.lower(clean(source)), clean(id_), clean(url), clean(title)
    owner = F.when(src != "", src).otherwise("unknown")
    return (
        F.when((src != "") & (rid != ""), F.concat_ws("::", src, rid))
        .when(link != "", F.concat_ws("::", owner, _digest(link)))
        .otherwise(F.concat_ws("::", owner, _digest(F.concat_ws("|", src, head))))
    )


def _digest(c: Column) -> Column:
    return F.substring(F.sha2(col(c), 256), 1, 16)
