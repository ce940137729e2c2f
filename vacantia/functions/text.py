"""Canonical text, titles, companies and identity hashes as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Legal suffixes of company names, and what may stand at the end of a title.
LEGAL_SUFFIX = (
    r"(?iU)[\s,]+(inc|llc|l\.l\.c|ltd|limited|gmbh|mbh|ug|bv|b\.v|nv|ab|oy|oyj|as|a/s|sa|s\.a"
    r"|sas|sarl|srl|spa|pty|plc|corp|corporation|company|co|kg|ag|aps|kft|sp z o o)\.?$"
)
TRAILING_NUMBER = r"\s*[(\[]?#?\d{4,}[)\]]?\s*$"
TRAILING_WORKPLACE = r"(?i)\s*[-–—(\[]\s*(remote|hybrid|on-?site)\s*[)\]]?\s*$"
TRAILING_SEPARATORS = r"[\s\-–—,;:/|]+$"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: ColumnOrName) -> Column:
    """Null as the empty string."""
    return F.coalesce(col(c), F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text; null where nothing is left."""
    t = F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")
    return F.when(F.length(t) > 0, t)


def squash(c: ColumnOrName) -> Column:
    """Runs of (Unicode) white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"(?U)[\s\u001c-\u001f]+", " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def look(table: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a table of texts, which the plan holds as one constant."""
    return F.try_element_at(F.str_to_map(F.lit("\x02".join(f"{a}\x01{b}" for a, b in table.items())), F.lit("\x02"), F.lit("\x01")), key)


@lru_cache(1)
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Lower-case letters whose caseless form is another: those that fold to one letter, and to several. By Unicode's rule, not listed."""
    one, several = {}, {}
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        low, form = c.lower(), c.casefold()
        if low != form and len(low) == 1:
            (one if len(form) == 1 else several)[low] = form
    return one, several


def fold(c: ColumnOrName) -> Column:
    """Caseless form: lower case, with the letters that fold to others or to more than one."""
    one, several = _folds()
    spell = lambda t: F.when(t.rlike("[" + "".join(several) + "]"), F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(look(several, c), c)), "")).otherwise(t)
    return let(F.translate(F.lower(col(c)), "".join(one), "".join(one.values())), spell)


def canon(c: ColumnOrName) -> Column:
    """White space squashed and case folded; null is the empty string."""
    return fold(squash(blank(c)))


def canon_bool(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def canon_list(c: ColumnOrName) -> Column:
    """Distinct canonical forms of the non-empty elements, sorted and joined by a bar."""
    named = F.filter(F.coalesce(col(c), F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != ""))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(named, canon))), "|")


def money_text(c: ColumnOrName) -> Column:
    """Two decimals, half to even on the shortest decimal form of the number; null is the empty string."""
    return F.coalesce(F.bround(col(c).cast("decimal(28,8)"), 2).cast("decimal(28,2)").cast("string"), F.lit(""))


def normalize_title(title: ColumnOrName, city: ColumnOrName | None = None) -> Column:
    """Folded title without trailing numbers, workplace and city marks; null where nothing is left.

    Marks come in any order, so each is taken off in up to four passes; a pass that changes nothing leaves the rest as they are.
    """
    text = fold(squash(title))
    place = None
    if city is not None:
        name = fold(blank_to_null(city))
        quoted = F.concat(F.lit(r"(?i)\s*[-–—(\[]\s*\Q"), F.replace(name, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(r"\E\s*[)\]]?\s*$"))
        place = F.coalesce(quoted, F.lit(r"(?!)"))
    for _ in range(4):
        text = F.regexp_replace(F.regexp_replace(text, TRAILING_NUMBER, ""), TRAILING_WORKPLACE, "")
        if place is not None:
            text = F.regexp_replace(text, place, F.lit(""))
        text = F.regexp_replace(text, TRAILING_SEPARATORS, "")
    text = squash(F.regexp_replace(text, r"(?U)([^\w\s])\1+", "$1"))
    return F.when(F.length(text) > 0, text)


def canon_company(name: ColumnOrName) -> Column:
    """Canonical company name without up to two legal suffixes and without punctuation."""
    text = canon(name)
    for _ in range(2):
        text = F.regexp_replace(text, LEGAL_SUFFIX, "")
    return squash(F.regexp_replace(text, r"(?U)[^\w\s]", " "))


# Words that end a company's name without naming it.
NAME_SUFFIXES = (
    "incorporated corporation limited holdings group inc llc ltd llp plc gmbh mbh ag kg bv nv sa srl spa oy ab as aps co corp company technologies labs".split()
)


def name_norm(name: ColumnOrName) -> Column:
    """Key of a company name: folded words without punctuation, all trailing suffix words taken off while another word is left; null without words."""
    words = F.filter(F.split(F.regexp_replace(fold(blank(name)), r"(?U)[^\w\s]+", " "), r"(?U)\s+"), lambda w: w != "")

    def named(found: Column) -> Column:
        names = F.filter(F.sequence(F.lit(1), F.size(found)), lambda k: ~F.element_at(found, k).isin(NAME_SUFFIXES))
        return F.array_join(F.slice(found, F.lit(1), F.coalesce(F.array_max(names), F.lit(1))), " ")

    return let(words, lambda found: F.when(F.size(found) > 0, named(found)))


def make_id(provider: ColumnOrName, company: ColumnOrName, source_id: ColumnOrName) -> Column:
    """provider:company:id in lower case; empty without an id, so that rows without one never share a key."""
    return F.when(F.length(blank(source_id)) > 0, F.lower(F.concat_ws(":", blank(provider), blank(company), col(source_id)))).otherwise("")


def short_sha1(parts: list[Column], digits: int) -> Column:
    """First digits of the SHA-1 of bar-joined parts, none of which may be null."""
    return F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, digits)


def content_key(title_normalized: ColumnOrName, company: ColumnOrName, location_raw: ColumnOrName, requisition_id: ColumnOrName) -> Column:
    """Whether two rows are the same advertisement."""
    return short_sha1([canon(title_normalized), canon_company(company), canon(location_raw), blank(requisition_id)], 16)


def change_hash(title, locations, department, remote, employment_type, salary_min, salary_max) -> Column:
    """Whether something changed that a reader cares about; the description is left out."""
    return short_sha1([canon(title), canon_list(locations), canon(department), canon_bool(remote), blank(employment_type), money_text(salary_min), money_text(salary_max)], 8)


def state_hash(title: ColumnOrName, location: ColumnOrName, department: ColumnOrName, remote: ColumnOrName) -> Column:
    """Hash of the compared fields of a stored posting; ``remote`` is a boolean column."""
    return short_sha1([canon(title), canon(location), canon(department), canon_bool(remote)], 8)


def org_code_stripped(department: ColumnOrName) -> Column:
    """Department name without a leading organisation code such as ``1234 - ``; the name itself where nothing else is there."""
    text = blank_to_null(department)
    bare = F.regexp_replace(text, r"^[A-Z]{0,4}\d[\w.]*\s*[-–—:|]?\s+", "")
    return F.coalesce(blank_to_null(bare), text)
