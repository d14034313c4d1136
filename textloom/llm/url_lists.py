"""URL lists over time: every capture is judged by the entries that were active when it was fetched.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("domain", "host", "prefix", "url")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def host_of(url: str | Column) -> Column:
    """Lower-case host without user, port and closing dot; empty for what is no URL with a host."""
    authority = F.regexp_extract(F.lower(F.trim(_c(url))), r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@|:\d*$", ""), r"\.+$", "")


def location_of(url: str | Column) -> Column:
    """Host and path: no scheme, query, fragment or closing slash."""
    path = F.regexp_extract(F.trim(_c(url)), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    return F.concat(host_of(url), F.regexp_replace(path, r"/+$", ""))


def intervals(entries: DataFrame, at: str = "at") -> DataFrame:
    """Validity intervals ``kind, pattern, category, valid_from, valid_to`` of dated list entries.

    ``entries`` has ``kind`` (one of ``KINDS``), ``pattern``, ``category``, ``action``
    (``add`` or ``remove``) and the date or timestamp ``at``. An entry is active from an
    ``add`` to the next ``remove``; of both at one time the ``remove`` comes first.
    Repeated entries, an ``add`` of what is active and a ``remove`` of what is not change
    nothing; rows with a null, or another kind or action, are left out. An open interval
    ends with null.
    """
    names = ["kind", "pattern", "category", "action", at]
    rows = entries.select(*names).dropna().filter(F.col("kind").isin(*KINDS) & F.col("action").isin("add", "remove"))
    # After this a key has at most two rows for each time, however often the lists repeat it.
    rows = rows.distinct().withColumn("_order", F.when(F.col("action") == "remove", 0).otherwise(1))
    by_time = Window.partitionBy("kind", "pattern", "category").orderBy(at, "_order")
    turns = rows.withColumn("_before", F.lag("action").over(by_time)).filter(
        ~F.col("action").eqNullSafe(F.col("_before"))
    )
    closed = turns.withColumn("valid_to", F.lead(at).over(by_time)).filter(F.col("action") == "add")
    return closed.select("kind", "pattern", "category", F.col(at).alias("valid_from"), "valid_to")


def listed_sizes(listed: DataFrame) -> dict[str, list[int]]:
    """Numbers of labels that listed domains have, and of steps that listed prefixes have; a few small numbers."""
    parts = F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\."))).otherwise(F.size(F.split("pattern", "/")))
    rows = listed.filter("kind in ('domain', 'prefix')").select("kind", parts.alias("n")).distinct().collect()
    return {kind: sorted(r.n for r in rows if r.kind == kind) for kind in ("domain", "prefix")}


def lookup_keys(url: str | Column, sizes: dict[str, list[int]] | None = None) -> Column:
    """Array of (kind, pattern) that could be listed for this URL.

    Every suffix of the host at a dot, the host, every prefix of the location at a slash
    and the location. The number of dots and slashes bounds its length; with ``sizes``
    only suffixes and prefixes of as many parts as some listed one has are among them, so
    a top-level domain, which nearly all captures share, is asked for only if it is listed.
    """
    host, location = host_of(url), location_of(url)
    labels, steps = F.split(host, r"\."), F.split(location, "/")

    def key(kind: str, pattern: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))

    def some(kind: str, numbers: Column, size) -> Column:
        return numbers if sizes is None else F.filter(numbers, lambda i: size(i).isin(sizes[kind]))

    domains = F.transform(
        some("domain", F.sequence(F.lit(1), F.size(labels)), lambda i: F.size(labels) - i + 1),
        lambda i: key("domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")),
    )
    prefixes = F.transform(
        some("prefix", F.sequence(F.lit(1), F.size(steps)), lambda i: i), lambda i: key("prefix", F.array_join(F.slice(steps, F.lit(1), i), "/"))
    )
    one = F.array(key("host", host), key("url", location))
    return F.when(host != "", F.array_distinct(F.concat(domains, one, prefixes)))


def judge(captures: DataFrame, listed: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Add ``blocked``, ``n_entries`` and ``categories`` to every row of ``captures``.

    ``listed`` holds ``intervals``; an entry counts when ``valid_from <= fetched < valid_to``.
    Null or malformed URLs and null times match nothing. Repeated rows stay, other columns
    pass through, existing columns of the three names are replaced. Each distinct URL and
    time is looked up once, by equality of key, so a popular host is spread over its URLs.
    """
    added = ["blocked", "n_entries", "categories"]
    rows = captures.drop(*added)
    # The names of this function's own columns cannot clash with those of the captures.
    asked = rows.select(F.col(url).alias("u"), F.col(fetched).alias("t")).dropna().distinct()
    keys = asked.select("u", "t", F.explode(lookup_keys("u", listed_sizes(listed))).alias("k")).select("u", "t", "k.kind", "k.pattern")
    active = (F.col("valid_from") <= F.col("t")) & (F.col("valid_to").isNull() | (F.col("t") < F.col("valid_to")))
    found = (
        keys.join(listed, ["kind", "pattern"])
        .filter(active)
        .groupBy("u", "t")
        .agg(
            F.count(F.lit(1)).alias("n_entries"),
            F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"),
        )
        .select(F.col("u").alias("_u"), F.col("t").alias("_t"), "n_entries", "categories")
    )
    joined = rows.join(found, (F.col(url) == F.col("_u")) & (F.col(fetched) == F.col("_t")), "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).alias("n_entries"),
        F.coalesce("categories", F.lit("")).alias("categories"),
    )
