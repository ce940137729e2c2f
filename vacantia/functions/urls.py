"""Posting and board URLs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, blank, col, fold, let

# Where providers put a board and a posting in their URLs.
_UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
POSTING_URLS = (
    ("lever", rf"(?i)^https?://jobs(?:\.eu)?\.lever\.co/([^/?#]+)/({_UUID})(?=$|[/?#])"),
    ("ashby", rf"(?i)^https?://jobs\.ashbyhq\.com/([^/?#]+)/({_UUID})(?=$|[/?#])"),
    ("rippling", rf"(?i)^https?://ats\.rippling\.com/([^/?#]+)/jobs/({_UUID})(?=$|[/?#])"),
)
UNSUPPORTED_URLS = (
    ("greenhouse", r"(?i)(?:job-boards|boards)\.greenhouse\.io|[?&]gh_jid="),
    ("recruitee", r"(?i)\.recruitee\.com/"),
    ("personio", r"(?i)\.jobs\.personio\.(?:com|de)/"),
)
BOARD_URLS = (
    ("greenhouse", r"^//(?:job-boards|boards)\.greenhouse\.io/(?:embed/job_board\?for=)?([A-Za-z0-9_.-]+)(?=[/?#]|$)"),
    ("lever", r"^//jobs(?:\.eu)?\.lever\.co/([A-Za-z0-9_.-]+)(?=[/?#]|$)"),
    ("ashby", r"^//jobs\.ashbyhq\.com/([A-Za-z0-9_.-]+)(?=[/?#]|$)"),
    ("recruitee", r"^//([A-Za-z0-9-]+)\.recruitee\.com(?=[/?#]|$)"),
    ("rippling", r"^//ats\.rippling\.com/([A-Za-z0-9_.-]+)(?=[/?#]|$)"),
    ("personio", r"^//([A-Za-z0-9-]+)\.jobs\.personio\.(?:de|com)(?=[/?#]|$)"),
)
RESERVED_SLUGS = ("embed", "api", "www", "sitemap", "robots", "assets", "static")
PROVIDERS = ("greenhouse", "lever", "ashby", "recruitee", "rippling", "personio")
SLUG = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,99}$"
DOMAIN = r"^[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
URLISH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://|^//|/"


def parse_posting_url(url: ColumnOrName) -> Column:
    """struct<provider, company, job_id>, null where the URL is not exactly a posting of a provider that names it there."""
    text = F.trim(col(url))
    return F.coalesce(*[F.when(text.rlike(p), F.struct(F.lit(name).alias("provider"), F.regexp_extract(text, p, 1).alias("company"), F.regexp_extract(text, p, 2).alias("job_id"))) for name, p in POSTING_URLS])


def unsupported_provider(url: ColumnOrName) -> Column:
    """Provider of a URL that is known but doesn't name a single posting."""
    return F.coalesce(*[F.when(col(url).rlike(p), F.lit(name)) for name, p in UNSUPPORTED_URLS])


def first_url(named: list[ColumnOrName], others: list[ColumnOrName]) -> Column:
    """A named column that is a posting, else any column that is, else the first named one with text."""
    resolves = lambda c: F.when(parse_posting_url(c).isNotNull(), F.trim(col(c)))
    text = lambda c: F.when(F.length(F.trim(col(c))) > 0, F.trim(col(c)))
    return F.coalesce(*map(resolves, [*named, *others]), *map(text, named))


def valid_slug(slug: ColumnOrName) -> Column:
    return F.coalesce(col(slug).rlike(SLUG) & ~F.lower(col(slug)).isin(*RESERVED_SLUGS), F.lit(False))


def canonical_url(url: ColumnOrName) -> Column:
    """``//authority/path?query`` of a URL with or without scheme, a leading www. and the fragment taken off; user info and ports stay, so that no host matches them."""
    text = F.trim(col(url))
    bare = F.when(text.contains("://"), F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*:(?=//)", "")).otherwise(F.concat(F.lit("//"), text))
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)#.*", ""), r"^//(?i:www\.)", "//")


def host_of(url: ColumnOrName) -> Column:
    """Lower-case host of a URL without user info, port and a leading www.; empty without one."""
    return F.regexp_replace(F.lower(F.regexp_extract(canonical_url(url), r"^//(?:[^/?]*@)?([^/?:@]*)", 1)), r"^www\.", "")


def looks_like_url(text: ColumnOrName) -> Column:
    return F.trim(blank(text)).rlike(URLISH)


def parse_board_url(url: ColumnOrName) -> Column:
    """struct<provider, slug, region> of a board's URL, case of the slug kept; null for any other."""
    none = F.lit(None).cast("string")

    def read(c: Column) -> Column:
        found = [F.when(c.rlike(p), F.struct(F.lit(name).alias("provider"), F.regexp_extract(c, p, 1).alias("slug"), (F.when(c.startswith("//jobs.eu."), "eu") if name == "lever" else none).alias("region"))) for name, p in BOARD_URLS]
        return let(F.coalesce(*found), lambda f: F.when(valid_slug(f["slug"]), f))

    return let(canonical_url(url), read)


def parse_prefix(text: ColumnOrName) -> Column:
    """struct<provider, slug, site> of ``provider:slug`` or ``provider:slug/site``; null for anything else. A site is of the same characters as a slug."""
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9_-]*)\s*:\s*(?!//)(\S.*)$"

    def read(t: Column) -> Column:
        rest = F.regexp_replace(F.trim(F.regexp_extract(t, pattern, 2)), r"^/+|/+$", "")
        parts = F.split(rest, "/", 2)
        site = F.when(F.get(parts, 1) != "", F.get(parts, 1))
        found = F.struct(F.lower(F.regexp_extract(t, pattern, 1)).alias("provider"), F.get(parts, 0).alias("slug"), site.alias("site"))
        fits = lambda f: f["provider"].isin(*PROVIDERS, "workday") & valid_slug(f["slug"]) & F.coalesce(f["site"].rlike(SLUG), F.lit(True))
        return F.when(t.rlike(pattern), let(found, lambda f: F.when(fits(f), f)))

    return let(F.trim(col(text)), read)


def pinned_ref(text: ColumnOrName, pin: str | None) -> Column:
    """struct<provider, slug, site> of a bare slug where only ``pin``'s boards are read; null for URLs and anything else."""
    none = F.lit(None).cast("string")
    slug = F.trim(col(text))
    found = F.struct(F.lit(pin).cast("string").alias("provider"), slug.alias("slug"), none.alias("site"))
    return F.when(F.lit(pin is not None) & ~looks_like_url(slug) & valid_slug(slug), found)


def needs_directory(text: ColumnOrName, pin: str | None = None) -> Column:
    """Whether only a directory of companies can tell what an entry names."""
    return parse_prefix(text).isNull() & parse_board_url(text).isNull() & pinned_ref(text, pin).isNull()


def company_key(provider: ColumnOrName, slug: ColumnOrName) -> Column:
    """Caseless key of a board."""
    return fold(F.concat_ws(":", blank(provider), blank(slug)))
