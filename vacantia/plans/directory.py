"""Directory plan: board candidates from URLs, ranked and merged, probed, and joined with the directory so far."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, name_norm
from ..functions.urls import parse_board_url, valid_slug
from ..operators.history import publishable
from ..operators.rows import prior_merge, ranked_merge

PUBLIC = ("provider", "slug", "name", "domain", "status", "job_count", "checked_at")
COLUMNS = ("key", "provider", "slug", "site", "region", "name", "name_norm", "domain", "status", "job_count", "first_seen", "checked_at", "dead_since")


def candidates(urls: DataFrame, url_col: str, rank: int) -> DataFrame:
    """Boards that URLs name, with the rank of their source and an order."""
    u = parse_board_url(url_col)
    return urls.select(u.alias("u"), F.col("ord")).where("u is not null").select("u.provider", "u.slug", "u.region", F.lit(rank).alias("rank"), "ord")


def merge_candidates(found: list[DataFrame], cap: int = 0) -> DataFrame:
    """One row a board: the best-ranked spelling, any source's region, at most ``cap`` of a provider in a hashed order."""
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f)
    keyed = whole.where(valid_slug("slug")).withColumn("key", fold("slug"))
    return ranked_merge(keyed, ["provider", "key"], ["rank", "ord"], ["region"], "provider" if cap else None, cap)


def probe(boards: DataFrame) -> DataFrame:
    """Status and count of landed boards: not found is dead, any other failure only unconfirmed, an ok board has its postings counted."""
    status = F.when(F.col("status") == "ok", "ok").when(F.col("status") == "not_found", "dead").otherwise("unconfirmed")
    return boards.select("provider", "slug", status.alias("status"), F.when(F.col("status") == "ok", F.col("job_count")).alias("job_count"), "name")


def build(prior: DataFrame, merged: DataFrame, probes: DataFrame, today: str) -> DataFrame:
    """Directory rows: probed ones anew, keeping first_seen; others as they were; dead_since is the first day a board was dead."""
    p = merged.select("provider", "key", "slug", "region").join(probes.select("provider", fold("slug").alias("key"), "status", "job_count", "name"), ["provider", "key"])
    old = prior.select("provider", "key", F.col("dead_since").alias("was_dead"))
    p = p.join(old, ["provider", "key"], "left").select(
        "key", "provider", "slug", F.lit(None).cast("string").alias("site"), "region", "name", name_norm("name").alias("name_norm"), F.lit(None).cast("string").alias("domain"), "status", F.col("job_count").cast("bigint").alias("job_count"),
        F.lit(today).alias("first_seen"), F.lit(today).alias("checked_at"), F.when(F.col("status") == "dead", F.coalesce("was_dead", F.lit(today))).alias("dead_since"),
    )
    return prior_merge(prior.select(*COLUMNS), p.select(*COLUMNS), ["provider", "key"]).orderBy("provider", "key")


def public(directory: DataFrame, blocklist: DataFrame) -> DataFrame:
    """The published columns of boards that aren't blocked."""
    return publishable(directory.withColumn("company", F.col("slug")), blocklist).where("status = 'ok'").select(*PUBLIC)


def read_blocklist(lines: DataFrame, lower_provider: bool = True) -> DataFrame:
    """(provider, company) of ``provider:slug`` lines; what follows a # is a comment."""
    bare = F.trim(F.regexp_replace("value", r"#.*$", ""))
    provider = F.regexp_extract(bare, r"^([^:]+):(.+)$", 1)
    return lines.select((F.lower(provider) if lower_provider else provider).alias("provider"), F.regexp_extract(bare, r"^([^:]+):(.+)$", 2).alias("company")).where("provider <> ''").distinct()


def expand_watchlist(watchlist: DataFrame, directory: DataFrame, today: str, least: int = 1) -> DataFrame:
    """Watchlist and the good boards of the directory that it lacks; its own rows win."""
    new = directory.where((F.col("status") == "ok") & (F.col("job_count") >= least)).select("provider", F.col("slug").alias("company"), "site")
    new = new.join(watchlist.select("provider", "company"), ["provider", "company"], "left_anti")
    return watchlist.unionByName(new.select("provider", "company", "site", F.lit(today).alias("added"), F.lit("directory").alias("source")))
