"""Column functions on text. Java's character classes are ASCII unless (?U) is set."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"
#: What (?U)\\s matches, for Python.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def word_count(c: Column) -> Column:
    """Runs of characters other than white space."""
    return F.size(F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")).cast("long")


def tokens(c: Column) -> Column:
    """Lower-cased runs of characters other than white space."""
    return F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")


def occurrences(c: Column, pattern: str) -> Column:
    """How often a pattern matches, without overlaps."""
    return F.size(F.regexp_extract_all(c, F.lit(pattern), F.lit(0))).cast("long")


def total(values: Column) -> Column:
    """The sum of an array of numbers, as a long."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def content_hash(c: Column) -> Column:
    """md5 of the text without link targets and ISO dates, with white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(c, r"\[([^\]]+)\]\([^\)]+\)", "[$1]"), r"(?U)\d{4}-\d{2}-\d{2}", "")
    return F.md5(strip(F.regexp_replace(bare, r"(?U)\s+", " ")).cast("binary"))


def identifier(c: Column) -> Column:
    """Lower-cased runs of a-z and 0-9, in order."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda t: t != "")


def contains_run(whole: Column, part: Column) -> Column:
    """Whether the tokens of part stand in whole one after another. Tokens hold no spaces; an empty part is in every list."""
    spaced = lambda x: F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" "))
    return (F.size(part) == 0) | F.contains(spaced(whole), spaced(part))


def without_fence(c: Column) -> Column:
    """An answer without the Markdown fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"(?U)^```(?:json)?\s*", ""), r"(?U)\s*```$", ""))


def snippet(c: Column, n: int = 300) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("..."))).otherwise(c)


def estimated_tokens(c: Column) -> Column:
    """Words and single marks: the token count where no tokenizer file is given; null or empty is 0."""
    return occurrences(F.coalesce(c, F.lit("")), r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]")


def token_budget(size: int, overlap: int, used: Column, n: Column) -> dict[str, Column]:
    """What a chunk of `size` tokens that holds `used` says to a block of n more."""
    return {
        "fits": used + n <= size,
        "remaining": F.greatest(F.lit(0), F.lit(size) - used).cast("long"),
        "should_start": used >= size,
        "overlap": F.least(F.lit(overlap), n).cast("long"),
        "new_content": F.lit(size - overlap).cast("long"),
    }
