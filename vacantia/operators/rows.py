"""Row operators of a run: filters, dedupe, delta, limits, sets and merges. Order-sensitive ones take an explicit order column."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, fold

# Units of relative cutoffs, in seconds.
UNITS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 30 * 86400, "year": 365 * 86400}


def parse_cutoff(text: str | None, now: datetime) -> datetime | None:
    """ISO 8601 (UTC without offset) or ``N unit[s] [ago]``; beyond the calendar the epoch; None for anything else."""
    import re

    text = (text or "").strip()
    m = re.fullmatch(r"(\d+)\s*([a-z]+?)s?(?:\s+ago)?", text.lower())
    if m and m[2] in UNITS:
        try:
            return now - timedelta(seconds=int(m[1]) * UNITS[m[2]])
        except OverflowError:
            return datetime(1970, 1, 1, tzinfo=timezone.utc)
    try:
        found = datetime.fromisoformat(text)
    except ValueError:
        return None
    return found if found.tzinfo else found.replace(tzinfo=timezone.utc)


@dataclass
class Filters:
    """Conjunction of a run's filters over job rows; an unset one keeps all."""

    title_include: list[str] = field(default_factory=list)
    title_exclude: list[str] = field(default_factory=list)
    locations: list[str] = field(default_factory=list)
    departments: list[str] = field(default_factory=list)
    employment_types: list[str] = field(default_factory=list)
    strict_employment: bool = False
    remote_only: bool = False
    posted_after: datetime | None = None

    @staticmethod
    def _needles(words: list[str]) -> list[str]:
        return [w.strip().casefold() for w in words if w and w.strip()]

    def _any(self, haystacks: list[Column], words: list[str]) -> Column:
        hit = F.lit(False)
        for h in haystacks:
            for w in words:
                hit = hit | F.contains(fold(blank(h)), F.lit(w))
        return hit

    def _located(self, needles: list[str]) -> Column:
        """Two letters are a country code and nothing else; longer ones may stand anywhere in a location."""
        parts = ("raw", "city", "region", "country", "countryCode")
        empty = F.array().cast("array<struct<raw:string,city:string,region:string,country:string,countryCode:string>>")
        places = F.concat(F.array(F.struct(F.col("locationRaw").alias("raw"), "city", "region", "country", "countryCode")), F.coalesce("locations", empty))
        short, long = [n for n in needles if len(n) <= 2], [n for n in needles if len(n) > 2]
        by_code = F.exists(places, lambda p: fold(blank(p["countryCode"])).isin(short)) if short else F.lit(False)
        by_text = F.exists(places, lambda p: self._any([p[k] for k in parts], long)) if long else F.lit(False)
        return by_code | by_text

    def predicate(self) -> Column:
        keep = F.lit(True)
        if words := self._needles(self.title_include):
            keep = keep & self._any([F.col("title")], words)
        if words := self._needles(self.title_exclude):
            keep = keep & ~self._any([F.col("title")], words)
        if words := self._needles(self.locations):
            keep = keep & self._located(words)
        if self.remote_only:
            keep = keep & F.col("remote").eqNullSafe(F.lit(True))
        if words := self._needles(self.departments):
            keep = keep & self._any([F.col("department"), F.col("team")], words)
        if self.strict_employment:
            keep = keep & F.col("employmentTypeSource").eqNullSafe(F.lit("ats"))
        if words := self._needles(self.employment_types):
            match = fold(F.col("employmentType")).isin(words)
            keep = keep & (match if self.strict_employment else F.col("employmentType").isNull() | match)
        if self.posted_after:
            posted = F.col("postedAt").try_cast("timestamp")
            keep = keep & (posted.isNull() | (posted >= F.lit(self.posted_after)))
        return F.coalesce(keep, F.lit(False))


def dedupe_first(rows: DataFrame, key: str | Column, order: list[Column | str]) -> DataFrame:
    """First row of each key; rows whose key is null or empty are all kept.

    Where the order is of plain columns a frequent key is combined before the shuffle; else its rows are sorted in one task.
    """
    k = F.col(key) if isinstance(key, str) else key
    keyed = rows.withColumn("__k", F.when(F.length(k.cast("string")) > 0, k.cast("string")))
    named = keyed.where("__k is not null")
    if all(isinstance(o, str) for o in order):
        columns = [F.col(f"`{c}`") for c in rows.columns]
        unique = named.groupBy("__k").agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__r")).select("__r.*")
    else:
        unique = named.withColumn("__n", F.row_number().over(Window.partitionBy("__k").orderBy(*order))).where("__n = 1").drop("__n", "__k")
    return unique.unionByName(keyed.where("__k is null").drop("__k"))


def dedupe_content(rows: DataFrame, id_col: str, content_col: str, order: list[Column | str]) -> DataFrame:
    """Survivors by content key, each with the sorted ids it swallowed as dedupedFrom (null if none); keyless rows are kept."""
    has = F.length(F.col(content_col)) > 0
    ranked = rows.where(has).withColumn("__n", F.row_number().over(Window.partitionBy(content_col).orderBy(*order)))
    lost = ranked.where("__n > 1").groupBy(content_col).agg(F.array_sort(F.collect_list(id_col)).alias("dedupedFrom"))
    kept = ranked.where("__n = 1").drop("__n").join(lost, content_col, "left")
    rest = rows.where(~F.coalesce(has, F.lit(False))).withColumn("dedupedFrom", F.lit(None).cast(kept.schema["dedupedFrom"].dataType))
    return kept.unionByName(rest)


def delta(rows: DataFrame, seen: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with an id that was not seen before."""
    return rows.where(F.length(F.col(id_col).cast("string")) > 0).join(seen.select(id_col), id_col, "left_anti")


def upsert_seen(seen: DataFrame, delivered: DataFrame, now: str, id_col: str = "id") -> DataFrame:
    """Seen-state after a run: only delivered rows are marked; firstSeen stays, lastSeen and changeHash are the newest."""
    new = delivered.groupBy(id_col).agg(F.max("changeHash").alias("n_hash")).withColumn("hit", F.lit(True))
    both = seen.join(new, id_col, "full_outer")
    return both.select(id_col, F.coalesce("firstSeen", F.lit(now)).alias("firstSeen"), F.when(F.col("hit"), F.lit(now)).otherwise(F.col("lastSeen")).alias("lastSeen"), F.coalesce("n_hash", "changeHash").alias("changeHash"))


def prune_seen(seen: DataFrame, now: datetime, days: int) -> DataFrame:
    """Entries seen within ``days`` (0 to 3650; 0 keeps all); an entry without a date is stale."""
    days = min(max(int(days), 0), 3650)
    return seen if days == 0 else seen.where(F.coalesce("lastSeen", F.lit("")) >= (now - timedelta(days=days)).strftime("%Y-%m-%dT%H:%M:%SZ"))


def per_group_limit(rows: DataFrame, group: list[str], order: list[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of each group; 0 is no limit."""
    if n <= 0:
        return rows
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def top_groups(rows: DataFrame, group: str, value: str, order: str, n: int = 3) -> DataFrame:
    """The ``n`` most frequent values of each group, ties by first encounter: group, value, count, rank."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n_rows"), F.min(order).alias("first_ord"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.col("n_rows").desc(), "first_ord")))
    return ranked.where(F.col("rank") <= n).select(group, value, "n_rows", "rank")


def interleave(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Rows dealt round-robin over the groups: each group's first, then each one's second, and so on."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(order))).orderBy("turn", group)


def ranked_merge(rows: DataFrame, keys: list[str], order: list[Column | str], fill: list[str], cap_by: str | None = None, cap: int = 0) -> DataFrame:
    """Best-ranked row of each key, its ``fill`` columns from the first row that has them, at most ``cap`` rows of each ``cap_by`` in a hashed order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = rows.select("*", F.row_number().over(w).alias("__n"), *[F.first(c, ignorenulls=True).over(whole).alias(f"__{c}") for c in fill])
    best = best.where("__n = 1").select(*[F.col(f"__{c}").alias(c) if c in fill else F.col(c) for c in rows.columns])
    return per_group_limit(best, [cap_by], [F.xxhash64(*keys), *keys], cap) if cap_by else best


def prior_merge(prior: DataFrame, probed: DataFrame, keys: list[str]) -> DataFrame:
    """Type-1 merge: probed rows replace prior ones, which keep first_seen and live on where they weren't probed."""
    cols = [c for c in prior.columns if c not in keys]
    p = prior.select(*keys, *[F.col(c).alias(f"p_{c}") for c in cols])
    n = probed.select(*keys, *[F.col(c).alias(f"n_{c}") for c in cols], F.lit(True).alias("hit"))
    both = p.join(n, keys, "full_outer")
    pick = lambda c: F.coalesce(f"p_{c}", f"n_{c}") if c == "first_seen" else F.when(F.col("hit"), F.col(f"n_{c}")).otherwise(F.col(f"p_{c}"))
    return both.select(*keys, *[pick(c).alias(c) for c in cols])


def overwrite_union(files: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several files by key: a later file's row overwrites an earlier one's, nulls included."""
    rows = [f.withColumn("__f", F.lit(i)) for i, f in enumerate(files)]
    whole = rows[0]
    for r in rows[1:]:
        whole = whole.unionByName(r, allowMissingColumns=True)
    cols = [c for c in whole.columns if c not in (*keys, "__f")]
    best = whole.groupBy(*keys).agg(F.max_by(F.struct(*cols), "__f").alias("__r"))
    return best.select(*keys, *[F.col("__r").getField(c).alias(c) for c in cols])


def left_fill(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str], prefer: str = "left") -> DataFrame:
    """Left join that fills ``cols``: the left value wins, or, with prefer="right", the right row's value wherever there is a right row, null included."""
    r = right.select(*keys, *[F.col(c).alias(f"__{c}") for c in cols], F.lit(True).alias("__hit"))
    pick = (lambda c: F.coalesce(c, f"__{c}")) if prefer == "left" else (lambda c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)))
    joined = left.join(r, keys, "left")
    return joined.select(*[pick(c).alias(c) if c in cols else F.col(c) for c in left.columns])


def resolve_entries(entries: DataFrame, directory: DataFrame) -> DataFrame:
    """(entry, n_found, status, provider, slug) by matching entry keys with the directory: none, one or several boards.

    ``entries`` has entry and key; ``directory`` key, rank (0 slug, 1 name, 2 domain), provider and slug. Of an entry's matches only those of
    the best rank count.
    """
    hits = entries.join(directory, "key", "left")
    best = hits.withColumn("best", F.min("rank").over(Window.partitionBy("entry"))).where("rank is null or rank = best")
    found = best.groupBy("entry").agg(F.count_distinct("provider", "slug").alias("n_found"), F.min(F.struct("provider", "slug")).alias("one"))
    one = F.col("n_found") == 1
    status = F.when(F.col("n_found") == 0, "not_found").when(one, "ok").otherwise("unconfirmed")
    return found.select("entry", "n_found", status.alias("status"), F.when(one, F.col("one.provider")).alias("provider"), F.when(one, F.col("one.slug")).alias("slug"))


def group_merge(rows: DataFrame, key: str, label: str, order: list[Column | str]) -> DataFrame:
    """First row of each key with all its distinct labels, sorted, as ``labels``."""
    first = dedupe_first(rows, key, order)
    labels = rows.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"))
    return first.join(labels, key, "left")
