"""Text scrubbing: real words replaced by made-up ones of a fixed list, the same each time; numbers and markup stay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, col

# Words that stand in, and mailboxes of a role, which name nobody.
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()
ROLES = "jobs careers career hr recruiting talent info contact bewerbung".split()


def scrub_words(text: ColumnOrName, words: list[str] | None = None) -> Column:
    """Every run of letters outside tags and entities becomes the word at its CRC-32. Applying it twice gives another text; see :func:`scrub_once`."""
    pool = F.array(*map(F.lit, words or WORDS))
    parts = F.regexp_extract_all(col(text), F.lit(r"(?U)(<[^>]*>|&#?\w+;|\p{L}+|[^\p{L}<&]+|[<&])"), F.lit(1))
    new = F.transform(parts, lambda p: F.when(p.rlike(r"^\p{L}+$"), F.element_at(pool, (F.crc32(p.cast("binary")) % len(words or WORDS) + 1).cast("int"))).otherwise(p))
    return F.array_join(new, "")


def scrub_once(text: ColumnOrName, least: int = 200) -> Column:
    """Texts of at least ``least`` characters scrubbed, unless all their words are of the list already."""
    t = col(text)
    found = F.regexp_extract_all(F.regexp_replace(t, r"<[^>]*>|&#?\w+;", " "), F.lit(r"(\p{L}+)"), F.lit(1))
    done = F.forall(found, lambda w: w.isin(WORDS))
    return F.when((F.length(t) >= least) & ~done, scrub_words(t)).otherwise(t)


def scrub_email(text: ColumnOrName) -> Column:
    """Personal mailboxes become a fixed one at example.com; mailboxes of a role stay."""
    roles = "|".join(ROLES)
    return F.regexp_replace(col(text), rf"(?i)(?<![\w.+-])(?!(?:{roles})@)[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,24}}", "person@example.com")
