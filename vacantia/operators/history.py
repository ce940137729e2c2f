"""Snapshot diff, event history and closure aggregates.

States and snapshots are keyed by (provider, company, job_id); days are dates passed in, never the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import days_open
from ..functions.text import canon, canon_bool, state_hash

KEY = ["provider", "company", "job_id"]
BOARD = ["provider", "company"]
EVENT_COLUMNS = ("d", "provider", "company", "job_id", "ev", "t", "loc", "dept", "url", "posted", "days_open", "changed", "verified")
STATE_COLUMNS = ("t", "loc", "dept", "remote", "url", "updated", "h", "first_seen", "last_seen", "posted", "posted_src")


def last_wins(rows: DataFrame, keys: list[str], ord_col: str) -> DataFrame:
    """Of several rows of a key the one with the greatest ``ord_col``; null order counts as smallest."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.coalesce(F.col(ord_col), F.lit(-1))).alias("__r"))
    return best.select(*keys, *[F.col("__r").getField(c).alias(c) for c in rest])


def diff(prev: DataFrame, cur: DataFrame, today: str) -> tuple[DataFrame, DataFrame]:
    """(next state, events) of a day: one full outer join on the key.

    ``prev`` has KEY and STATE_COLUMNS; ``cur`` has KEY, t, loc, dept, remote, url, posted, updated, one row a key (see :func:`last_wins`). An
    unknown department is filled from the state before hashing and is never a change. A removed posting whose title, place,
    remote flag and, where both are known, department are open under a new id keeps its event without days_open.
    """
    p = prev.select(*KEY, *[F.col(c).alias(f"o_{c}") for c in STATE_COLUMNS], F.lit(True).alias("o"))
    n = cur.select(*KEY, *[F.col(c).alias(f"n_{c}") for c in ("t", "loc", "dept", "remote", "url", "posted", "updated")], F.lit(True).alias("n"))
    both = p.join(n, KEY, "full_outer")
    known = F.when(F.length(F.coalesce("o_dept", F.lit(""))) > 0, F.col("o_dept"))
    both = both.withColumn("n_dept", F.coalesce("n_dept", known)).withColumn("n_h", state_hash("n_t", "n_loc", "n_dept", "n_remote"))
    day = F.lit(today)
    posted = F.substring(F.coalesce(_some("o_posted"), _some("n_posted"), day), 1, 10)
    source = F.coalesce(_some("o_posted_src"), F.when(_some("n_posted").isNotNull(), "api").otherwise("snapshot"))
    fields = {"t": canon, "loc": canon, "dept": canon, "remote": canon_bool}
    differs = {k: f(f"o_{k}") != f(f"n_{k}") for k, f in fields.items()}
    differs["dept"] &= (canon("o_dept") != "") & (canon("n_dept") != "")
    changed = F.array_compact(F.array(*[F.when(d, F.lit(k)) for k, d in differs.items()]))
    kind = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(~F.col("o_h").eqNullSafe(F.col("n_h")) & (F.size(changed) > 0), "changed")
    both = both.withColumn("ev", kind).withColumn("changed", F.when(F.col("ev") == "changed", changed)).withColumn("new_posted", posted).withColumn("new_src", source)
    state = both.where("n").select(
        *KEY, *[F.col(f"n_{c}").alias(c) for c in ("t", "loc", "dept", "remote", "url", "updated")], F.col("n_h").alias("h"), F.coalesce("o_first_seen", day).alias("first_seen"), day.alias("last_seen"), F.col("new_posted").alias("posted"), F.col("new_src").alias("posted_src")
    )
    gone = F.col("ev") == "removed"
    pick = lambda c: F.when(gone, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}"))
    events = both.where("ev is not null").select(
        day.alias("d"), *KEY, "ev", pick("t").alias("t"), pick("loc").alias("loc"), pick("dept").alias("dept"), pick("remote").alias("remote"), pick("url").alias("url"),
        F.when(gone, F.col("o_posted")).otherwise(F.col("new_posted")).alias("posted"), F.when(gone, days_open(day, "o_posted")).alias("days_open"), "changed", F.lit(None).cast("boolean").alias("verified"),
    )
    return state, suppress_reposts(events).select(*EVENT_COLUMNS)


def _some(c: str) -> Column:
    """The text of a column; null where empty."""
    return F.when(F.length(F.col(c)) > 0, F.col(c))


def suppress_reposts(events: DataFrame) -> DataFrame:
    """Null days_open of removed events whose posting was added again under another id, by a hash join on its canonical form.

    Departments that either side lacks match any: a form's added departments are gathered to a distinct set first, so
    that a board adding many alike postings costs no square.
    """
    form = [canon("t").alias("ct"), canon("loc").alias("cl"), canon_bool("remote").alias("cr")]
    added = events.where("ev = 'added'").select(*BOARD, *form, canon("dept").alias("cd"))
    added = added.groupBy(*BOARD, "ct", "cl", "cr").agg(F.collect_set("cd").alias("depts"))
    keyed = events.select("*", *form, canon("dept").alias("cd")).join(added, [*BOARD, "ct", "cl", "cr"], "left")
    again = F.col("depts").isNotNull() & ((F.col("cd") == "") | F.array_contains("depts", "") | F.array_contains("depts", F.col("cd")))
    return keyed.withColumn("days_open", F.when((F.col("ev") == "removed") & again, None).otherwise(F.col("days_open"))).select(*events.columns)


def verify_removals(events: DataFrame, state: DataFrame, prev: DataFrame, verdicts: DataFrame, patience: int = 3) -> tuple[DataFrame, DataFrame]:
    """(events, state) after asking the provider about removals.

    ``verdicts`` (KEY, verdict): gone verifies the removal; live drops the event, keeps the posting open and counts ``omitted``;
    unknown keeps it open until the ``patience``-th time in a row, when the removal stands unverified. Providers without verdicts
    keep their removals as they are. ``prev`` may have columns omitted and unverified.
    """
    counters = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in prev.columns else F.lit(0).alias(c) for c in ("omitted", "unverified")]
    asked = events.where("ev = 'removed'").join(verdicts.select(*KEY, "verdict"), KEY).join(prev.select(*KEY, *counters), KEY)
    asked = asked.withColumn("waits", (F.col("verdict") == "live") | ((F.col("verdict") == "unknown") & (F.col("unverified") + 1 < patience)))
    judged = asked.select(*KEY, F.lit("removed").alias("ev"), "waits", F.when(F.col("verdict") == "gone", True).otherwise(False).alias("answer"))
    out = events.join(judged, [*KEY, "ev"], "left").where("not coalesce(waits, false)").withColumn("verified", F.coalesce("answer", "verified")).select(*events.columns)
    kept = prev.join(asked.where("waits").select(*KEY, "verdict"), KEY)
    base = [c for c in state.columns if c not in ("omitted", "unverified")]
    old = {c: F.coalesce(F.col(c), F.lit(0)) if c in prev.columns else F.lit(0) for c in ("omitted", "unverified")}
    live = F.col("verdict") == "live"
    kept = kept.select(*base, F.when(live, old["omitted"] + 1).otherwise(old["omitted"]).alias("omitted"), F.when(live, 0).otherwise(old["unverified"] + 1).alias("unverified"))
    return out, state.select(*base, F.lit(0).alias("omitted"), F.lit(0).alias("unverified")).unionByName(kept)


def first_days(counts: DataFrame) -> DataFrame:
    """First measured day of each board, over the whole store."""
    return counts.groupBy(*BOARD).agg(F.min("d").alias("first_d"))


def closure_summary(counts: DataFrame, events: DataFrame, all_counts: DataFrame | None = None, ord_col: str | None = None) -> DataFrame:
    """Company-days: d, provider, company, open, added, removed, net, with the measured days driving.

    A day without a counts row isn't there, which is not zero. On a board's first day (over ``all_counts``) added and net
    are null, as everything was new to us. A day that is empty and has removals is a wiped feed and is left out.
    """
    keys = ["d", *BOARD]
    measured = counts.groupBy(*keys).agg((F.max_by("open", ord_col) if ord_col else F.max("open")).alias("open"))
    tally = events.groupBy(*keys).agg(F.count_if(F.col("ev") == "added").alias("added"), F.count_if(F.col("ev") == "removed").alias("removed"))
    day = measured.join(tally, keys, "left").na.fill(0, ["added", "removed"]).where("not (open = 0 and removed > 0)")
    day = day.join(first_days(all_counts if all_counts is not None else counts), BOARD)
    base = F.col("d") == F.col("first_d")
    return day.select(*keys, "open", F.when(~base, F.col("added")).alias("added"), "removed", F.when(~base, F.col("added") - F.col("removed")).alias("net"))


def trustworthy_events(counts: DataFrame, events: DataFrame) -> DataFrame:
    """Events of measured company-days that are no wiped feeds, in order."""
    keys = ["d", *BOARD]
    gone = events.where("ev = 'removed'").select(*keys).distinct()
    wiped = counts.where("open = 0").join(gone, keys, "left_semi").select(*keys)
    trusted = counts.select(*keys).distinct().join(wiped, keys, "left_anti")
    return events.join(trusted, keys, "left_semi").orderBy("d", *BOARD, "ev", "job_id")


def publishable(rows: DataFrame, blocklist: DataFrame, providers_out: tuple[str, ...] = ()) -> DataFrame:
    """Rows of boards that are neither on the list nor of a provider that is kept back."""
    kept = rows.where(~F.col("provider").isin(*providers_out)) if providers_out else rows
    return kept.join(blocklist.select(*BOARD).distinct(), BOARD, "left_anti")


def recent_days(rows: DataFrame, window: int = 3) -> DataFrame:
    """Rows of the last ``window`` distinct days present: the days are found by a small aggregate and joined back."""
    days = rows.groupBy("d").agg(F.lit(1).alias("one")).orderBy(F.col("d").desc()).limit(window).select("d")
    return rows.join(F.broadcast(days), "d", "left_semi")


def degraded(rows: DataFrame, group: str, size: str, least: int = 5, share: float = 0.9) -> DataFrame:
    """Groups of at least ``least`` measured boards of which more than ``share`` are empty."""
    seen = rows.groupBy(group).agg(F.count("*").alias("seen"), F.count_if(F.col(size) == 0).alias("zero"))
    return seen.withColumn("degraded", (F.col("seen") >= least) & (F.col("zero") / F.col("seen") > share))


def age_index(state: DataFrame) -> DataFrame:
    """Boards with their postings nested: p, c, t (tracked since), j as sorted array<struct<job_id, posted, first_seen>>."""
    return state.groupBy(F.col("provider").alias("p"), F.col("company").alias("c")).agg(F.min("first_seen").alias("t"), F.array_sort(F.collect_list(F.struct("job_id", "posted", "first_seen"))).alias("j"))


def bucket_of(provider: str | Column, company: str | Column, buckets: int = 64) -> Column:
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return (F.crc32(F.concat_ws(":", c(provider), c(company)).cast("binary")) % buckets).cast("int")


def shard_of(bucket: Column, shards: int, buckets: int = 64) -> Column:
    return F.least(F.lit(shards - 1), F.floor(bucket * shards / buckets).cast("int"))


def prune(rows: DataFrame, today: str, days: int = 400, day_col: str = "d") -> DataFrame:
    """Rows not older than ``days`` before ``today``; a day that isn't a date prunes nothing."""
    return rows.where(F.col(day_col).cast("string") >= F.date_sub(F.lit(today).try_cast("date"), days).cast("string")) if _is_day(today) else rows


def _is_day(text: str) -> bool:
    from datetime import date

    try:
        date.fromisoformat(text)
    except (TypeError, ValueError):
        return False
    return True


def purge(rows: DataFrame, provider: str, company: str | None = None) -> DataFrame:
    """Rows without those of a provider, or of one of its companies."""
    hit = F.col("provider") == provider
    return rows.where(~(hit & (F.col("company") == company) if company is not None else hit))


def guard_day(boards: DataFrame, company_state: DataFrame, degraded_providers: DataFrame, stale_after: int = 7) -> DataFrame:
    """What may happen to each board on a day: action, status, consecutive_failures, stale.

    ``boards`` has BOARD, fetch_status and jobs; ``company_state`` BOARD, status, consecutive_failures and open. Boards of degraded providers
    are left untouched; a failed fetch counts; an empty board that had postings is suspect first and believed the second time.
    """
    flag = degraded_providers.select("provider", F.lit(True).alias("bad"))
    b = boards.join(company_state.select(*BOARD, F.col("status").alias("was"), F.coalesce("consecutive_failures", F.lit(0)).alias("fails"), F.coalesce("open", F.lit(0)).alias("had")), BOARD, "left").join(F.broadcast(flag), "provider", "left")
    failed = F.col("fetch_status") != "ok"
    suspect = (F.col("jobs") == 0) & (F.col("had") > 0) & ~F.coalesce(F.col("was") == "empty_suspect", F.lit(False))
    action = F.when(F.coalesce("bad", F.lit(False)), "skip_degraded").when(failed, "keep_failed").when(suspect, "mark_suspect").otherwise("diff")
    fails = F.when(F.col("action") == "keep_failed", F.coalesce("fails", F.lit(0)) + 1).when(F.col("action") == "skip_degraded", F.coalesce("fails", F.lit(0))).otherwise(0)
    status = F.when(F.col("action") == "mark_suspect", "empty_suspect").when(F.col("action") == "diff", "ok").otherwise(F.col("was"))
    return b.withColumn("action", action).select(*boards.columns, "action", status.alias("status"), fails.alias("consecutive_failures"), (fails >= stale_after).alias("stale"))
