"""Fixed schemas and vocabularies of the job dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCATION = "struct<raw:string,city:string,region:string,country:string,countryCode:string>"
# The dataset's columns in order, and the shorter profiles.
JOB_SCHEMA = (
    "recordType string, id string, contentKey string, changeHash string, provider string, companySlug string, company string, companyDomain string, title string, "
    "titleNormalized string, department string, team string, locationRaw string, city string, region string, country string, countryCode string, "
    f"locations array<{LOCATION}>, remote boolean, workplaceType string, remoteSource string, employmentType string, employmentTypeRaw string, employmentTypeSource string, "
    "seniority string, yearsOfExperience string, salaryMin double, salaryMax double, salaryCurrency string, salaryInterval string, salarySource string, salaryRaw string, "
    "url string, applyUrl string, postedAt string, postedAtSource string, updatedAt string, descriptionHtml string, descriptionText string, descriptionRedacted boolean, "
    "requisitionId string, sourceId string, dedupedFrom array<string>, isNew boolean, firstSeenAt string, scrapedAt string, raw string, input string, warnings array<string>"
)
MINIMAL = "recordType id title company locationRaw city countryCode remote url postedAt".split()
COMPACT = MINIMAL + "provider companySlug department employmentType employmentTypeSource salaryMin salaryMax salaryCurrency salaryInterval applyUrl updatedAt isNew".split()
PROFILES = {"minimal": MINIMAL, "compact": COMPACT}
#: Landed answers of providers, the input of an ingest: one row a board.
RAW_BOARDS = "provider string, slug string, input string, status string, body string, ord bigint"


def to_profile(jobs: DataFrame, profile: str) -> DataFrame:
    """Columns of a profile, empty lists as null; an unknown profile is the whole row."""
    names = PROFILES.get(profile, jobs.columns)
    empty_to_null = lambda c: F.when(F.size(c) > 0, F.col(c)).alias(c) if c in ("locations", "dedupedFrom", "warnings") else F.col(c)
    return jobs.select(*map(empty_to_null, names))
