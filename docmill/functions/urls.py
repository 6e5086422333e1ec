"""Column functions on URLs, and the decision whether to crawl one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reasons of a decision, the patterns and parameters that are excluded by default.
DUPLICATE = "Duplicate: already crawled"
DOMAIN = "Domain not allowed"
PATTERN = "Matches exclusion pattern"
PAGINATION = "Pagination URL excluded"
KEYWORDS = "Missing required path keywords"
SHORT = "Path too short (likely top-level navigation)"
BINARY_PATTERNS = (r".*\.pdf$", r".*\.jpg$", r".*\.png$", r".*\.gif$", r".*\.(zip|gz|tar)$")
PAGINATION_KEYS = ("page", "offset", "start", "page_num", "pagenum")
DROPPED_KEYS = ("hl",)

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def authority(url: Column) -> Column:
    """Host and port, as written."""
    return F.regexp_extract(url, _PARTS, 2)


def path(url: Column) -> Column:
    """The path without the ;parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(url, _PARTS, 3), r";[^/]*$", "")


def query(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 4)


def _decoded(x: Column) -> Column:
    """Form decoding: a plus is a space; a percent sign that starts no byte stays."""
    return F.url_decode(F.regexp_replace(x, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(x: Column) -> Column:
    """Form encoding: all but letters, digits and _.-~ as bytes, a space as a plus."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def parameters(url: Column) -> Column:
    """The key=value pairs of the query whose value is not blank, decoded, in order."""
    filled = F.filter(F.split(query(url), "&"), lambda p: p.rlike("(?s)^[^=]*=."))
    return F.transform(filled, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("key"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("value")))


def normalize(url: Column) -> Column:
    """Without fragment, `hl` and blank parameters; parameters of one key stand together, decoded and encoded anew; the
    host is in lower case. A URL without a scheme or host begins with ://, as an empty one does."""
    kept = F.filter(parameters(url), lambda p: ~p["key"].isin(*DROPPED_KEYS))
    keys = F.array_distinct(F.transform(kept, lambda p: p["key"]))
    grouped = F.flatten(F.transform(keys, lambda k: F.filter(kept, lambda p: p["key"] == k)))
    text = F.array_join(F.transform(grouped, lambda p: F.concat(_encoded(p["key"]), F.lit("="), _encoded(p["value"]))), "&")
    return F.concat(scheme(url), F.lit("://"), F.lower(authority(url)), path(url), F.when(F.size(grouped) > 0, F.concat(F.lit("?"), text)).otherwise(""))


def domain_allowed(url: Column, domains: Sequence[str]) -> Column:
    """Whether the host and port is one of the domains or below one; no domains allow all."""
    if not domains:
        return F.lit(True)
    host = F.lower(authority(url))
    return F.exists(F.array(*[F.lit(d.lower()) for d in domains]), lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d)))


def pattern_excluded(url: Column, patterns: Sequence[str]) -> Column:
    """Whether any pattern matches from the start on."""
    return url.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")") if patterns else F.lit(False)


def paginated(url: Column) -> Column:
    return F.arrays_overlap(F.transform(parameters(url), lambda p: p["key"]), F.array(*map(F.lit, PAGINATION_KEYS)))


@dataclass(frozen=True)
class UrlFilter:
    allowed_domains: Sequence[str] = ()
    exclude_patterns: Sequence[str] = ()
    allow_pagination: bool = False
    required_path_keywords: Sequence[str] = ()
    min_path_length: int = 0
    extra: Sequence[tuple[str, Column]] = field(default=())

    def reason(self, url: Column, seen: Column | None = None) -> Column:
        """The first reason against the URL; null if there is none."""
        steps = [(DUPLICATE, seen if seen is not None else F.lit(False)), (DOMAIN, ~domain_allowed(url, self.allowed_domains)), (PATTERN, pattern_excluded(url, self.exclude_patterns))]
        if not self.allow_pagination:
            steps.append((PAGINATION, paginated(url)))
        if self.required_path_keywords:
            words = F.array(*[F.lit(k.lower()) for k in self.required_path_keywords])
            steps.append((KEYWORDS, ~F.exists(words, lambda k: F.contains(F.lower(path(url)), k))))
        steps += [(SHORT, F.length(path(url)) < self.min_path_length), *self.extra]
        return reduce(lambda c, s: c.when(s[1], s[0]), steps[1:], F.when(steps[0][1], steps[0][0]))


#: What a crawl excludes where nothing else is said: binary files, pagination, and paths of fewer than ten characters.
DEFAULT_RULES = UrlFilter(exclude_patterns=BINARY_PATTERNS, min_path_length=10)


def filter_urls(urls: DataFrame, rules: UrlFilter = DEFAULT_RULES, url: str = "url", visited: DataFrame | None = None) -> DataFrame:
    """urls with `norm_url` and `filter_reason`; visited has norm_url.

    With a column `seq`, rows behind the first one of their norm_url that the rules let through are duplicates of it.
    """
    out = urls.withColumn("norm_url", normalize(F.col(url)))
    seen = F.lit(False)
    if visited is not None:
        out = out.join(visited.select("norm_url", F.lit(True).alias("_seen")).distinct(), "norm_url", "left")
        seen = F.coalesce("_seen", F.lit(False))
    out = out.withColumn("filter_reason", rules.reason(F.col(url), seen)).drop("_seen")
    if "seq" not in urls.columns:
        return out
    first = out.where("filter_reason IS NULL").groupBy("norm_url").agg(F.min("seq").alias("_first"))
    again = F.coalesce(F.col("seq") > F.col("_first"), F.lit(False))
    return out.join(first, "norm_url", "left").withColumn("filter_reason", F.when(again, DUPLICATE).otherwise(F.col("filter_reason"))).drop("_first")


def filter_report(filtered: DataFrame) -> DataFrame:
    """Filtered URLs by reason, and the total under the reason null."""
    return filtered.where(F.col("filter_reason").isNotNull()).rollup("filter_reason").agg(F.count(F.lit(1)).alias("n"))


def _folded(link: Column) -> Column:
    """A path, with the query and fragment behind it, without . and .. segments."""
    whole = F.regexp_extract(link, "^[^?#]*", 0)
    parts = F.split(F.regexp_replace(whole, "^/", ""), "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda a, p: F.when(p == ".", a).when(p == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(p))),
    )
    end = F.when(whole.rlike(r"(^|/)\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end, F.regexp_replace(link, "^[^?#]*", ""))


def resolve(base: Column, link: Column) -> Column:
    """The URL of a link on a page: absolute, //host, /path, ?query, #fragment or relative; . and .. segments are folded."""
    root = F.concat(scheme(base), F.lit("://"), authority(base))
    folder = F.regexp_replace(F.regexp_extract(base, _PARTS, 3), "[^/]*$", "")
    plain = F.regexp_replace(base, "#.*$", "")
    whole = F.when(link.startswith("/"), link).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), link))
    return (
        F.when(link == "", base)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme(base), F.lit(":"), link))
        .when(link.startswith("#"), F.concat(plain, link))
        .when(link.startswith("?"), F.concat(F.regexp_replace(plain, r"\?.*$", ""), link))
        .otherwise(F.concat(root, F.when(whole.rlike(r"/\.\.?(/|$|[?#])"), _folded(whole)).otherwise(whole)))
    )


def latest_version(names: DataFrame, name: str = "name") -> DataFrame:
    """The folder v<number> of the greatest number (v0 if there is none), and the next one."""
    number = F.max(F.when(F.col(name).rlike(r"^v\d+$"), F.regexp_extract(name, r"^v(\d+)$", 1).cast("int")))
    best = F.coalesce(number, F.lit(0))
    return names.agg(F.concat(F.lit("v"), best).alias("latest"), F.concat(F.lit("v"), best + 1).alias("next"))


def raw_file_name(url: Column) -> Column:
    """The name of a crawled document: its path, or `index`."""
    flat = F.replace(F.regexp_replace(path(url), "^/+|/+$", ""), F.lit("/"), F.lit("_"))
    return F.when(flat == "", "index").otherwise(flat)


def processed_file_name(url: Column) -> Column:
    return F.translate(F.substring_index(url, "://", -1), "/.", "__")
