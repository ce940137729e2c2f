"""Remote and employment detection as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .location import is_region_only, strip_workplace_markers
from .text import ColumnOrName, blank, blank_to_null, col, fold

# Words by which postings say where work is done, and how providers name employment types.
HYBRID = r"(?i)\bhybrid\b"
ONSITE = r"(?i)\b(on-?site|in-?office|in person|in-person)\b"
REGION_REMOTE = r"(?i)\b(remote|anywhere|worldwide|distributed)\b"
LOCATION_REMOTE = r"(?i)\b(remote|work from home|wfh|telecommute)\b"
TITLE_REMOTE = r"(?i)\bremote\b"
BODY_REMOTE = r"(?i)\b(fully|100%)\s+remote\b"
BODY_LABEL = r"(?im)^\s*(location|workplace|work\s+type)\s*:.*\bremote\b"
BODY_CHARS = 1500
WORKPLACES = {"remote": "remote", "hybrid": "hybrid", "onsite": "onsite", "on_site": "onsite", "inoffice": "onsite", "inperson": "onsite"}
EMPLOYMENT_TYPES = {
    "fulltime": "full_time",
    "parttime": "part_time",
    "contract": "contract",
    "contractor": "contract",
    "freelance": "contract",
    "temporary": "temporary",
    "intern": "internship",
    "internship": "internship",
    "permanent": "full_time",
    "trainee": "internship",
    "workingstudent": "part_time",
    "apprenticeship": "internship",
    "volunteer": "other",
    "salariedft": "full_time",
    "salariedfulltime": "full_time",
    "salariedpt": "part_time",
    "salariedparttime": "part_time",
    "hourlyft": "full_time",
    "hourlyfulltime": "full_time",
    "hourlypt": "part_time",
    "hourlyparttime": "part_time",
    "temp": "temporary",
}
TITLE_EMPLOYMENT = (
    (r"(?i)\b(intern|internship|praktikum|working student|werkstudent)\b", "internship"),
    (r"(?i)\b(contract(or)?|freelance|b2b)\b", "contract"),
    (r"(?i)\bpart[- ]time\b", "part_time"),
    (r"(?i)\b(temporary|maternity cover|fixed[- ]term)\b", "temporary"),
)


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def _answer(remote: bool | Column, workplace: str | Column | None, source: str) -> Column:
    r = remote if isinstance(remote, Column) else F.lit(remote)
    w = workplace if isinstance(workplace, Column) else F.lit(workplace).cast("string")
    return F.struct(r.alias("remote"), w.alias("workplaceType"), F.lit(source).alias("remoteSource"))


def _read(text: Column, pattern: str, source: str) -> Column:
    """Hybrid and on-site outrank remote; null where the text says nothing."""
    return F.when(text.rlike(HYBRID), _answer(False, "hybrid", source)).when(text.rlike(ONSITE), _answer(False, "onsite", source)).when(text.rlike(pattern), _answer(True, "remote", source))


def detect_remote(workplace_type=None, remote=None, hybrid=None, on_site=None, is_remote=None, location=None, title=None, description_head=None) -> Column:
    """struct<remote, workplaceType, remoteSource> by the first source that says anything: the provider's fields, the location, the title, the description.

    Arguments are columns; one left out is as one that is null everywhere. ``description_head`` is to be given only where descriptions are wanted.
    """
    null_text, null_bool = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    c = lambda x, default: default if x is None else col(x)
    token = lookup(WORKPLACES, F.regexp_replace(fold(c(workplace_type, null_text)), "[^a-z_]", ""))
    flags = [F.when(c(f, null_bool), _answer(name == "remote", name, "ats")) for f, name in ((remote, "remote"), (hybrid, "hybrid"), (on_site, "onsite"))]
    given = c(is_remote, null_bool)
    raw, name = blank(c(location, null_text)), blank(c(title, null_text))
    head = F.substring(c(description_head, null_text), 1, BODY_CHARS)
    stripped, marker = strip_workplace_markers(raw)
    region = (F.length(raw) > 0) & is_region_only(F.when(F.length(stripped) > 0, stripped).otherwise(raw))
    return F.coalesce(
        F.when(token.isNotNull(), _answer(token == "remote", token, "ats")),
        *flags,
        F.when(given.isNotNull(), _answer(given, F.when(given, "remote"), "ats")),
        _read(marker, REGION_REMOTE, "location"),
        F.when(region, _read(raw, REGION_REMOTE, "location")),
        _read(raw, LOCATION_REMOTE, "location"),
        _read(name, TITLE_REMOTE, "title"),
        F.when(head.rlike(BODY_REMOTE) | head.rlike(BODY_LABEL), _answer(True, "remote", "description")),
        F.struct(null_bool.alias("remote"), null_text.alias("workplaceType"), null_text.alias("remoteSource")),
    )


def employment_from_title(title: ColumnOrName) -> Column:
    return F.coalesce(*[F.when(col(title).rlike(p), F.lit(kind)) for p, kind in TITLE_EMPLOYMENT])


def detect_employment(value: ColumnOrName, title: ColumnOrName, schedule: ColumnOrName | None = None) -> Column:
    """struct<employmentType, employmentTypeRaw, employmentTypeSource>; the title is asked only where the provider is silent."""
    key = lambda c: F.regexp_replace(fold(c), "[^a-z]", "")
    raw = blank_to_null(value)
    resolved = F.coalesce(lookup(EMPLOYMENT_TYPES, key(raw)), F.lit("other"))
    if schedule is not None:
        refined = lookup(EMPLOYMENT_TYPES, key(blank_to_null(schedule)))
        resolved = F.when(refined.isin("full_time", "part_time") & resolved.isin("full_time", "other"), refined).otherwise(resolved)
    guess = employment_from_title(title)
    null = F.lit(None).cast("string")
    return F.when(raw.isNotNull(), F.struct(resolved.alias("employmentType"), raw.alias("employmentTypeRaw"), F.lit("ats").alias("employmentTypeSource"))).otherwise(
        F.struct(guess.alias("employmentType"), null.alias("employmentTypeRaw"), F.when(guess.isNotNull(), "title").alias("employmentTypeSource"))
    )
