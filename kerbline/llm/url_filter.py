"""URL filter: host and path rules, then a blocked Bloom filter in front of an exact join.

A listed URL is blocked. Pages whose canonical URL fails the blocked Bloom filter are surely not listed and are never
shuffled. Those that pass are joined with the list itself, which removes the false positives, so results do not depend on
the filter's size.

The tables hold no list, so the query makes one as a feed would be: all canonical URLs on hosts with a spam word anywhere in
a label, and on every other host the reported ones, a share of them by hash. Hosts thus have listed and unlisted URLs.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule and is never listed; repeated rows are
judged alike; of rules of equal length the first in order of action, host and path wins; URLs of any length are read whole;
an empty list or table gives no blocks; a null in the list lists nothing; further columns may have any names, those named
like the result's are replaced.
"""

from pyspark.sql import functions as F

from kerbline.llm import bloom

RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
SPAM_HOST = r"adult|bets|casino|pills|spam|(^|[.-])ads([.-]|$)"
#: Reported URLs: those whose digest begins with one of these digits, an eighth of them.
REPORTED = "01"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url):
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), UPPER, LOWER)


def path_of(url):
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def canonical(host, path):
    """Host without ``www.`` and path without a closing slash; null where there is no host."""
    bare = F.regexp_replace(host, r"^www\.", "")
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def rule_columns(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, null where none does.

    The rules are a literal list of a few hundred at most; they become one expression.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r))
    name = verdict = None
    for action, domain, prefix in ordered:
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        if name is None:
            name, verdict = F.when(fits, domain + prefix), F.when(fits, action)
        else:
            name, verdict = name.when(fits, domain + prefix), verdict.when(fits, action)
    if name is None:
        name = verdict = F.lit(None).cast("string")
    return name, verdict


def feed(urls, spam=SPAM_HOST, reported=REPORTED):
    """(canonical): the list of the op9 query, made from the URLs themselves by the rule above."""
    host = host_of(F.col("url"))
    listed = urls.select(host.alias("host"), canonical(host, path_of(F.col("url"))).alias("canonical"))
    by_digest = F.substring(F.md5("canonical"), 1, 1).isin(*reported)
    return listed.where(F.col("host").rlike(spam) | by_digest).select("canonical")


def judge(urls, listed, rules=RULES, max_blocks=bloom.MAX_BLOCKS):
    """Add host, path, rule and verdict to ``urls`` (column ``url``); ``listed`` has one column ``canonical``."""
    listed = listed.where(F.col("canonical").isNotNull()).distinct()
    added = ("host", "path", "rule", "verdict")
    own = [c for c in urls.columns if c.lower() not in added]
    parsed = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("page"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    )
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page", "host", "path", rule.alias("rule"), ruled.alias("ruled"))
    key = F.when(F.col("ruled").isNull(), canonical(F.col("host"), F.col("path")))
    parsed = parsed.withColumn("canonical", key)
    sure, maybe = bloom.split(parsed, F.col("canonical"), listed, F.col("canonical"), max_blocks)
    hits = maybe.join(listed.withColumn("listed", F.lit(True)), "canonical", "left")
    both = sure.withColumn("listed", F.lit(False)).unionByName(hits)
    verdict = F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return both.select(*[F.col("page").getField(c).alias(c) for c in own], "host", "path", "rule", verdict.alias("verdict"))
