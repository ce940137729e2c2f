"""The live source's rules, without a network."""

import gzip
import io
import json
import urllib.error

import pytest

from vacantia.functions import scrub
from vacantia.sources.http import BoardSource, Pace, allowed, fetch, read_capped


class Answers:
    """An opener that gives one prepared answer after the other."""

    def __init__(self, *answers):
        self.left, self.calls = list(answers), 0

    def __call__(self, request, timeout):
        self.calls += 1
        a = self.left.pop(0)
        if isinstance(a, int):
            raise urllib.error.HTTPError(request.full_url, a, "x", {"Retry-After": "7"} if a == 429 else {}, None)
        if isinstance(a, Exception):
            raise a
        return io.BytesIO(a)


@pytest.mark.parametrize(
    ("answers", "want", "calls"),
    [((b"[1]",), ("ok", "[1]"), 1), ((404,), ("not_found", None), 1), ((403,), ("error", None), 1), ((500, 429, b"{}"), ("ok", "{}"), 3), ((429,) * 4, ("rate_limited", None), 4), ((b"{", b"{}"), ("ok", "{}"), 2), ((b"{", b"{"), ("parse_error", None), 2), ((TimeoutError(), TimeoutError()), ("timeout", None), 2)],
)
def test_fetch(answers, want, calls):
    slept, opener = [], Answers(*answers)
    assert fetch("https://api.lever.co/x", Pace(1e9), opener, slept.append) == want and opener.calls == calls
    assert 429 not in answers or 7.0 in slept


def test_pace_and_caps():
    now, slept = [0.0], []
    pace = Pace(2, lambda: now[0], slept.append)
    pace.wait(), pace.wait(), pace.wait()
    assert slept == [0.5, 1.0]
    assert read_capped(io.BytesIO(gzip.compress(b"abc"))) == b"abc"
    with pytest.raises(ValueError, match="large"):
        read_capped(io.BytesIO(gzip.compress(b"a" * 1000)), 500)


def test_hosts():
    assert allowed("https://api.lever.co/v0") and allowed("https://acme.recruitee.com/api")
    assert not any(map(allowed, ("http://api.lever.co", "https://evil.com", "https://api.lever.co.evil.com", "https://u@api.lever.co", "https://api.lever.co:8080", "https://127.0.0.1")))


def test_source_gives_a_row_for_each_request(spark):
    spark.dataSource.register(BoardSource)
    requests = [{"provider": "lever", "slug": "a", "url": "https://localhost/x"}, {"provider": "lever", "slug": "b", "url": "http://169.254.169.254/"}]
    rows = spark.read.format("boards").option("requests", json.dumps(requests)).load().orderBy("ord").collect()
    assert [(r["slug"], r["status"]) for r in rows] == [("a", "refused"), ("b", "refused")]


def test_scrubbing(spark):
    df = spark.createDataFrame([("<b>Hello</b> world 42 &amp; " * 10,)], "t string")
    once, twice = df.select(scrub.scrub_once("t").alias("t")), df.select(scrub.scrub_once("t").alias("t")).select(scrub.scrub_once("t").alias("t"))
    text = once.first()[0]
    assert text == twice.first()[0] and text.count("<b>") == 10 and "42 &amp;" in text and "Hello" not in text
    mails = spark.createDataFrame([("jane@acme.com jobs@acme.com",)], "t string").select(scrub.scrub_email("t")).first()[0]
    assert mails == "person@example.com jobs@acme.com"
