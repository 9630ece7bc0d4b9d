"""URL filter: written rules first, mined association rules for what they leave open.

Only DataFrame and SQL functions: FP-growth mines token combinations that go with a bad label,
and an inverted index from each rule's rarest token finds the rules a URL holds.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from mercato.llm.tables import attach, stage

MARK = "!bad"  # the label among the items; no token has this form
LEAST_SUPPORT = 0.005
LEAST_COUNT = 5
LEAST_CONFIDENCE = 0.5


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def parts(url: Column) -> dict[str, Column]:
    """Scheme, host, path and tail. Without ``://`` (or null) all are empty."""
    u = F.coalesce(url, F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.regexp_extract(after, r"^[^?#]*", 0)
    return {
        "scheme": ascii_lower(F.when(at > 0, F.substring(u, F.lit(1), at - 1)).otherwise("")),
        "host": ascii_lower(host),
        "path": path,
        "tail": F.substring(after, F.length(path) + 1, F.length(after)),
    }


def tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, path parts with numbers made equal, query keys."""
    p = parts(url)
    named = lambda name, values: F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(name), v))
    path = F.split(F.regexp_replace(ascii_lower(p["path"]), "[0-9]+", "0"), "/")
    keys = F.regexp_extract_all(ascii_lower(p["tail"]), F.lit("[?&]([^=&#]+)"), 1)
    return F.array_distinct(F.concat(named("s=", F.array(p["scheme"])), named("h=", F.split(p["host"], r"\.")), named("p=", path), named("q=", keys)))


def written_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits a URL, and its verdict; null if none does.

    A rule is ``host/path``: it fits that host and its subdomains if the URL's path starts with
    the rule's. Rules are a written policy, so they are constants of the plan.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, word in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, slash, rest = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + rest)
        found, verdict = F.when(fits, text).otherwise(found), F.when(fits, word).otherwise(verdict)
    return found, verdict


def mine(labelled: DataFrame, url: str = "url", bad: str = "bad") -> DataFrame | None:
    """Rules (array of tokens, rarest token) for bad URLs from rows with a 0/1 ``bad``.

    A rule is a set of tokens that at least max(``LEAST_COUNT``, ``LEAST_SUPPORT`` of the rows)
    bad URLs hold and of whose holders at least ``LEAST_CONFIDENCE`` are bad. Rows of null label are
    left out; None if no row is left.
    """
    held = tokens(F.col(url))
    rows = labelled.where(F.col(bad).isNotNull()).select(F.when(F.col(bad) == 1, F.array_append(held, F.lit(MARK))).otherwise(held).alias("items"))
    rows = stage(rows.where(F.size("items") > 0), "url-items")
    n = rows.count()
    if not n:
        return None
    least = max(LEAST_COUNT, -(-n * LEAST_SUPPORT // 1))
    if least > n:
        return None
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=LEAST_CONFIDENCE).fit(rows)
    rules = model.associationRules.where(F.array_contains("consequent", MARK)).select(F.col("antecedent").alias("rule"))
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (
        rules.withColumn("token", F.explode("rule")).join(single, "token")
        .groupBy(F.array_sort("rule").alias("rule")).agg(F.min(F.struct("freq", "token")).alias("least"))
    )
    return stage(rarest.select("rule", F.col("least.token").alias("token")), "url-rules")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame, url: str = "url", bad: str = "bad") -> DataFrame:
    """``pages`` with host, path, rule, verdict and mined (true where a mined rule gave it).

    Null URLs and URLs without ``://`` have empty host and path and no tokens: no rule fits, the
    verdict is allow. Each distinct URL is matched once, so copies and hot hosts cost nothing
    more, and every row of a URL gets the same verdict. Other columns pass through (columns of
    the five names are replaced).
    """
    added = ("host", "path", "rule", "verdict", "mined")
    p = parts(F.col(url))
    rule, said = written_rule(p["host"], p["path"], rules)
    kept = [c for c in pages.columns if c not in added]
    told = pages.select(*kept, p["host"].alias("host"), p["path"].alias("path"), rule.alias("rule"), said.alias("_said"))
    mined = mine(labelled, url, bad)
    if mined is None:
        return told.select(*kept, "host", "path", "rule", F.coalesce("_said", F.lit("allow")).alias("verdict"), F.lit(False).alias("mined"))
    open_ = told.where(F.col("_said").isNull() & (F.col("host") != "")).select(F.col(url).alias("_url")).distinct()
    held = open_.select("_url", tokens(F.col("_url")).alias("_held"))
    # The rules go to the tokens while their count allows it, so a token that most URLs hold stays where it is.
    hits = attach(held.withColumn("token", F.explode("_held")), mined, ["token"], "inner").where(F.size(F.array_except("rule", "_held")) == 0)
    hits = stage(hits.select("_url").distinct().withColumn("_hit", F.lit(True)), "url-hits")
    out = attach(told.withColumn("_url", F.when(F.col("_said").isNull(), F.col(url))), hits, ["_url"])
    hit = F.coalesce("_hit", F.lit(False))
    verdict = F.coalesce("_said", F.when(hit, "block").otherwise("allow"))
    return out.select(*kept, "host", "path", "rule", verdict.alias("verdict"), hit.alias("mined"))
