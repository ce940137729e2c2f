"""Golden values of the scalar functions."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from vacantia.functions import dates, html, location, redact, salary, text, urls, work


def values(spark, make, cases):
    """Results of a Column function over one string column."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").select("v").collect()]


def test_titles(spark):
    cases = {"Engineer - Berlin (Remote) #12345": "engineer", "Senior  Dev (Hybrid)": "senior dev", "C++ Developer": "c+ developer", "Data!!! Lead": "data! lead", "  ": None, "Straße": "strasse"}
    assert values(spark, lambda c: text.normalize_title(c, F.lit("Berlin")), cases) == list(cases.values())
    city = spark.createDataFrame([("Nurse - St. Gallen", "St. Gallen"), ("A \\E b - x", "x"), ("Chef", None)], "t string, c string")
    assert [r[0] for r in city.select(text.normalize_title("t", "c")).collect()] == ["nurse", "a \\e b", "chef"]


def test_companies_and_keys(spark):
    assert values(spark, text.canon_company, ["Acme Inc. Ltd", "Foo, GmbH", "A&B Co", None]) == ["acme", "foo", "a b", ""]
    assert values(spark, text.name_norm, ["Acme Inc. Ltd", "Co", "Foo-Bar B.V"]) == ["acme", "co", "foo bar b v"]
    import hashlib

    key = values(spark, lambda c: text.content_key(c, F.lit("Acme Inc"), F.lit(" Berlin "), F.lit(None).cast("string")), ["Dev"])[0]
    assert key == hashlib.sha1(b"dev|acme|berlin|").hexdigest()[:16]
    ids = spark.createDataFrame([("Lever", "Acme", "X1"), ("lever", "a", None)], "p string, c string, i string").select(text.make_id("p", "c", "i"))
    assert [r[0] for r in ids.collect()] == ["lever:acme:x1", ""]
    assert values(spark, lambda c: text.money_text(c.cast("double")), ["180000", "0.125", None]) == ["180000.00", "0.12", ""]


def test_dates(spark):
    cases = {"2026-08-19": "2026-08-19T00:00:00Z", "2026-08-19T10:00:00+02:00": "2026-08-19T08:00:00Z", "1700000000000": "2023-11-14T22:13:20Z", "1700000000": "2023-11-14T22:13:20Z", "-5": None, "12:30": None, "Posted 30+ Days Ago": None, "2026": "1970-01-01T00:33:46Z", "20269999999999999999": None}
    assert values(spark, dates.to_iso, cases) == list(cases.values())
    assert values(spark, lambda c: dates.days_open(F.lit("2026-01-10"), c), ["2026-01-01T05", "2026-02-01", "x", None]) == [9, 0, None, None]
    assert values(spark, lambda c: dates.days_between(c, F.lit("2026-01-10")), ["2026-01-01", "2026-02-01", "x", None]) == [9, None, None, None]


def test_employment_and_remote(spark):
    cases = {"Full-time": "full_time", "SALARIED_FT": "full_time", "Trainee": "internship", "odd": "other", " ": None}
    assert values(spark, lambda c: work.detect_employment(c, F.lit("Chef"))["employmentType"], cases) == list(cases.values())
    assert values(spark, lambda c: work.employment_from_title(c), ["Internal auditor", "Working Student IT", "Part time clerk"]) == [None, "internship", "part_time"]
    assert values(spark, lambda c: work.detect_employment(c, F.lit("x"), F.lit("part-time"))["employmentType"], ["permanent", "intern"]) == ["part_time", "internship"]
    remote = lambda c: F.concat_ws("|", *[F.coalesce(work.detect_remote(location=c)[k].cast("string"), F.lit("-")) for k in ("remote", "workplaceType", "remoteSource")])
    cases = {"Remote - Berlin": "true|remote|location", "Hybrid": "false|hybrid|location", "EMEA": "-|-|-", "Anywhere": "true|remote|location", "Berlin": "-|-|-", "Paris (On-site)": "false|onsite|location"}
    assert values(spark, remote, cases) == list(cases.values())


PLACES = [
    ("Berlin, Germany", ("Berlin", None, "DE")), ("San Francisco, CA", ("San Francisco", "CA", "US")), ("London", ("London", None, None)), ("Remote - US", (None, None, "US")), ("Atlanta, Georgia", ("Atlanta", "Georgia", "US")),
    ("Germany, Munich (HQ)", ("Munich (HQ)", None, "DE")), ("EMEA", (None, None, None)), ("Sydney, NSW, Australia", ("Sydney", "NSW", "AU")), ("Tokyo, Japan; Singapore", ("Tokyo", None, "JP")), ("", (None, None, None)),
]


def test_locations(spark):
    got = many(spark, location.parse_locations, [(raw,) for raw, _ in PLACES])
    assert [(p["primary"]["city"], p["primary"]["region"], p["primary"]["countryCode"]) for p in got] == [want for _, want in PLACES]


def many(spark, make, rows):
    """The values of a Column function of texts (or arrays of texts), one a row."""
    kinds = ["array<string>" if any(isinstance(r[k], list) for r in rows) else "string" for k in range(len(rows[0]))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ", ".join(["i int", *(f"c{k} {t}" for k, t in enumerate(kinds))]))
    return [r["v"] for r in df.select("i", make(*df.columns[1:]).alias("v")).orderBy("i").collect()]


def one(spark, make, *values):
    return many(spark, make, [values])[0]


def test_location_lists(spark):
    listed = '[{"city": "Oslo", "country_code": "no"}, {"state": {"name": "Bavaria"}, "country": "Deutschland"}, {}]'
    rows = [
        ("Hybrid", ["Berlin, Germany", "Berlin, Germany", "Paris, France"], None), ("a and b", [], None), (None, [], '{"addressLocality": "Bonn", "addressCountry": "DEU"}'), ("Oslo", ["Munich", "Graz, Austria"], listed),
        (None, None, None), ("Macau", [], None), ("Saint Lucia", [], None), ("Oslo, Norway", ["Bergen, Norway"], None),
    ]
    got = many(spark, location.parse_locations, rows)
    assert got[0]["primary"].asDict() == {"raw": "Hybrid", "city": "Berlin", "region": None, "country": "Germany", "countryCode": "DE"} and len(got[0]["locations"]) == 3
    assert got[1]["locations"][0]["raw"] == "a and b"
    assert tuple(got[2]["primary"]) == ("Bonn, Germany", "Bonn", None, "Germany", "DE")
    assert [(p["raw"], p["city"], p["region"], p["countryCode"]) for p in got[3]["locations"]] == [("Graz, Austria", "Graz", None, "AT"), ("Munich", None, "Bavaria", "DE"), ("Oslo", "Oslo", None, "NO")]
    assert got[4] == Row(primary=Row(raw=None, city=None, region=None, country=None, countryCode=None), locations=[])
    assert got[5]["primary"]["country"] == "Macao" and got[6]["primary"]["countryCode"] == "LC" and len(got[7]["locations"]) == 2


def test_urls_of_boards_and_prefixes(spark):
    cases = {
        "https://jobs.lever.co/acme": ("lever", "acme", None), "https://jobs.eu.lever.co/Acme/x?y": ("lever", "Acme", "eu"), "boards.greenhouse.io/embed/job_board?for=acme": ("greenhouse", "acme", None), "https://WWW.jobs.ashbyhq.com/a.b#c": ("ashby", "a.b", None),
        "Acme.recruitee.com": ("recruitee", "Acme", None), "https://jobs.lever.co/acme%20x": None, "https://boards.greenhouse.io/acme@evil": None, "https://jobs.lever.co/sitemap": None, "https://jobs.lever.co/careers": ("lever", "careers", None),
        "https://evil.test/r?u=//jobs.lever.co/acme": None, "https://x@jobs.lever.co/acme": None, "https://jobs.lever.co:80/acme": None, "https://evil.test/#//a.recruitee.com": None,
    }
    assert [r and tuple(r) for r in many(spark, urls.parse_board_url, [(u,) for u in cases])] == list(cases.values())
    cases = {"lever:acme": ("lever", "acme", None), " Workday : nvidia/Site/ ": ("workday", "nvidia", "Site"), "workday:nvidia/a b": None, "lever:a%b": None, "other:acme": None, "lever://acme": None, "lever:robots": None, "recruitee:localhost:6379?": None}
    assert [r and tuple(r) for r in many(spark, urls.parse_prefix, [(t,) for t in cases])] == list(cases.values())
    assert one(spark, lambda c: urls.host_of(c), "https://u:p@www.Example.org:8080/x?y#z") == "example.org"
    assert [one(spark, lambda c, p=p: urls.needs_directory(c, p), "acme") for p in (None, "lever")] == [True, False]


def test_caseless_forms_follow_unicode(spark):
    letters = "µſςßŉǰΐﬁﬃﬅΑΣᾳẞİꭰᎠA"
    assert one(spark, text.fold, letters) == letters.casefold()
    names = {"Acme Technologies, Inc.": "acme", "Inc": "inc", "Foo Holdings Group Ltd": "foo", "Labs Labs Labs Labs Labs Labs Labs Labs x": "labs labs labs labs labs labs labs labs x", " . ": None, "": None}
    assert many(spark, text.name_norm, [(n,) for n in [*names, None]]) == [*names.values(), None]


def test_days_open_of_unreadable_dates(spark):
    days = ["2026-01-01", "2026-02-01", "2026-01-03T10:00:00Z", "soon", "", None]
    assert many(spark, lambda c: dates.days_open(F.lit("2026-01-10"), c), [(d,) for d in days]) == [9, 0, 7, None, None, None]


WORDS = [
    ("$120k - $150k", (120000, 150000, "USD", "year")), ("EUR 50,000 to 60,000 per year", (50000, 60000, "EUR", "year")), ("£15 - £20 per hour", (15, 20, "GBP", "hour")), ("CA$90,000 - 100,000 annually", (90000, 100000, "CAD", "year")),
    ("bonus 10k - 20k", None), ("1990 - 2000", None), ("5-10 years", None), ("10% - 20%", None), ("$10 - $900 per hour", None), ("30,000 - 40,000 EUR gross", (30000, 40000, "EUR", "year")),
]


def test_salary_text(spark):
    got = many(spark, salary.salary_in_text, [(words,) for words, _ in WORDS])
    assert [s and (s["min"], s["max"], s["currency"], s["interval"]) for s in got] == [want for _, want in WORDS]


def test_salary_scans_three_ranges_and_keeps_words(spark):
    texts = {"1-2 days or 3-4 weeks, pays $50k - $60k": (50000, "$50k - $60k"), "1-2 days, 3-4 weeks, 5-6 hours, pays $50k - $60k": None, "Budget 5 - 6 and 70.000 to 80.000 EUR": None, "paid 20 – 25 USD / hr": (20, "20 – 25 USD")}
    assert [s and (s["min"], s["raw"]) for s in many(spark, salary.salary_in_text, [(t,) for t in texts])] == list(texts.values())


def test_salary_objects(spark):
    band = lambda title, lo, hi, cur="USD": {"title": title, "min_cents": lo * 100, "max_cents": hi * 100, "currency_type": cur}
    lever = lambda lo, hi, i: {"salaryRange": {"min": lo, "max": hi, "currency": "USD", "interval": i}}
    tiers = [{"compensationType": "Salary", "minValue": lo, "maxValue": hi, "currencyCode": c, "interval": i} for lo, hi, c, i in ((1, 2, "EUR", "1 YEAR"), (120000, 150000, "USD", "1 YEAR"), (100000, 180000, "USD", "1 YEAR"))]
    cases = [  # payload, country, code, description, and the pay
        ({"pay_input_ranges": [band("Base pay range", 80000, 120000), band("On-target earnings", 90000, 200000)]}, None, None, None, (80000, 120000, "USD", "year", "ats", None)),
        ({"pay_input_ranges": [band("US", 80000, 120000), band("Ireland", 60000, 70000, "EUR")]}, "Ireland", None, None, (60000, 70000, "EUR", "year", "ats", None)),
        ({"pay_input_ranges": [band("A", 80000, 120000), band("B", 60000, 70000, "EUR")]}, "Ireland", "IE", None, (60000, 70000, "EUR", "year", "ats", None)),
        ({"pay_input_ranges": [band("Zone A", 80000, 120000), band("Zone B", 70000, 90000)]}, None, None, None, (70000, 120000, "USD", "year", "ats", "Zone A / Zone B")),
        ({"pay_input_ranges": [band("Hourly", 20, 30), band("Yearly", 70000, 90000)]}, None, None, None, (20, 30, "USD", "hour", "ats", "Hourly")),
        ({"compensation": {"compensationTierSummary": "$100K", "summaryComponents": [*tiers, {"compensationType": "EquityPercentage"}]}}, None, None, None, (100000, 180000, "USD", "year", "ats", "$100K")),
        (lever(22.4, 26, "bi-week-salary"), None, None, None, (22.4, 26, "USD", None, "ats", None)), (lever(1200, 1500, "bi-week-salary"), None, None, None, (1200, 1500, "USD", "week", "ats", None)),
        (lever(90000, 120000, "per-hour-wage"), None, None, None, (90000, 120000, "USD", None, "ats", None)), (lever(0, 150000, "per-year-salary"), None, None, None, (0, 150000, "USD", "year", "ats", None)),
        ({"salaryRange": {"min": 0, "max": 0, "currency": "USD"}, "salaryDescription": "Competitive"}, None, None, None, (None, None, None, None, None, "Competitive")),
        ({}, None, None, "We pay $120k - $150k.", (120000, 150000, "USD", "year", "parsed", "$120k - $150k")), ({"salary": {"min": "50 000", "max": None, "period": "yearly"}}, None, None, None, (50000, None, None, "year", "ats", None)),
    ]
    got = many(spark, salary.parse_salary, [(json.dumps(job), head, None, None, country, code, None) for job, country, code, head, _ in cases])
    assert [tuple(g) for g in got] == [c[-1] for c in cases]
    intervals = {"1 YEAR": "year", "1 HOUR": "hour", "2 WEEKS": None, "3 MONTHS": None, "YEAR": "year", "PER_YEAR": None, "": None}
    assert many(spark, lambda c: salary.counted_interval(F.col(c)), [(i,) for i in intervals]) == list(intervals.values())


def test_html(spark):
    cases = {"<p>a</p><script>var t='</p>'</script><p>b &amp; c</p>": "a\n\nb & c", "x<br>y": "x\ny", "": None, "<!-- c --><a title='>'>z</a>": "z"}
    assert values(spark, html.html_to_text, cases) == list(cases.values())
    assert values(spark, html.sanitize_html, ["<b onclick=x>a</b><script>1</script><a href='javascript:x'>b</a><iframe src=q>"]) == ["<b>a</b><a href='#'>b</a>"]
    assert values(spark, html.unescape_once, ["&amp;lt;"]) == ["&lt;"]


def test_redaction(spark):
    cases = {
        "mail a.b@c.de now": "mail [redacted] now", "from an @acme.com alias": "from an @acme.com alias", "Tel. 030 / 12 34 56 78": "Tel. [redacted]", "up to $215,000 - 260.000": "up to $215,000 - 260.000", "+1 more": "+1 more", "call +49 30 1234567.": "call [redacted].",
        "linkedin.com/in/jane and linkedin.com/company/acme": "[redacted] and linkedin.com/company/acme", "WhatsApp: @jane": "WhatsApp: [redacted]", "Kontakt: Anna Schmidt.": "Kontakt: [redacted].", "report to Anna Schmidt": "report to Anna Schmidt",
    }
    assert values(spark, redact.redact_text, cases) == list(cases.values())
    kept = '{"ownership":"b","notes":["Ansprechpartner: Anna Schmidt.","WhatsApp: @jane"],"descriptionBodyPlain":"x","tel":"1","owner":{"a":1},"n":null,"k":1.5}'
    deep = '{"a":{"a":{"a":{"a":{"a":{"a":{"a":{"a":{"a":1}}}}}}}}}'
    first = '{"id":1,"mailbox_email":"x","a":[{"t":"a@b.com","phone":1}],"description":"d"}'
    got = many(spark, redact.strip_contact_fields, [(p,) for p in (first, kept, "not json", None, "[]", deep)])
    assert got[0] == '{"id":1,"a":[{"t":"[redacted]"}]}' and got[2:5] == [None, None, "[]"] and got[5].endswith('{"a":null}}}}}}}}}')
    assert json.loads(got[1]) == {"ownership": "b", "notes": ["Ansprechpartner: [redacted].", "WhatsApp: [redacted]"], "n": None, "k": 1.5}


def test_urls(spark):
    uuid = "12345678-1234-1234-1234-123456789abc"
    posting = lambda c: F.concat_ws("|", urls.parse_posting_url(c)["provider"], urls.parse_posting_url(c)["company"])
    assert values(spark, posting, [f"https://jobs.lever.co/Acme/{uuid}?x", f"https://jobs.ashbyhq.com/a/{uuid}junk", f"https://ats.rippling.com/r/jobs/{uuid}"]) == ["lever|Acme", "", "rippling|r"]
    board = lambda c: urls.parse_board_url(c)["slug"]
    assert values(spark, board, ["https://www.jobs.lever.co/AcmeCo/x", "user@jobs.lever.co/a", "https://Foo.recruitee.com", "https://x.jobs.personio.de/", "https://jobs.lever.co:80/a"]) == ["AcmeCo", None, "Foo", "x", None]
    prefix = lambda c: F.concat_ws("|", urls.parse_prefix(c)["provider"], urls.parse_prefix(c)["slug"], urls.parse_prefix(c)["site"])
    assert values(spark, prefix, ["Lever:Acme", "workday:a/site", "foo:bar", "lever:"]) == ["lever|Acme", "workday|a|site", "", ""]
