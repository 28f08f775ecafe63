"""Operator 10 (native): URL filter by host and path rules and by mined rules.

Fixed rules come first: a rule fits its host and all subdomains of it if the
path starts with the rule's path, and the longest fitting rule decides.  Every
other url is judged by association rules: FP-growth mines combinations of url
tokens from labelled pages; rules that conclude the block label with enough
support and confidence are kept, and match through an inverted index from a
rule's rarest token to the rule.  DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ITEM = "label:block"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path:
    from there up to ``?``, ``#`` or the end."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    before_query = F.regexp_extract(rest, r"^([^?#]*)", 1)
    host = F.regexp_extract(before_query, r"^([^/]*)", 1)
    path = F.substring(before_query, F.length(host) + 1, F.length(before_query))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does.

    ``rules``: (verdict, text) with the host up to the first ``/`` and the
    path from there.  Of equally long rules the first listed wins."""
    fitted, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, slash, tail = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + tail)
        fitted = F.coalesce(fitted, F.when(fits, F.lit(text)))
        verdict = F.coalesce(verdict, F.when(fits, F.lit(kind)))
    return fitted, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels and the words in them,
    path segments (numbers as one token) and query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(host, r"[.\-_0-9]+"), lambda x: F.length(x) > 2)
    segments = F.filter(F.split(F.lower(path), "/"), lambda x: x != "")
    segments = F.transform(segments, lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.filter(F.split(F.lower(query), "[&;]"), lambda x: x != "")
    keys = F.transform(keys, lambda x: F.regexp_extract(x, "^([^=]*)", 1))
    scheme = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    return F.array_distinct(
        F.concat(
            F.when(scheme != "", F.array(F.concat(F.lit("scheme:"), scheme))).otherwise(F.array().cast("array<string>")),
            F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
            F.transform(F.array_except(words, labels), lambda x: F.concat(F.lit("word:"), x)),
            F.transform(segments, lambda x: F.concat(F.lit("path:"), x)),
            F.transform(keys, lambda x: F.concat(F.lit("query:"), x)),
        )
    )


def mine_rules(labelled: DataFrame, min_pages: int, min_confidence: float) -> DataFrame:
    """``(tokens, confidence, support)`` of the rules that conclude block.

    ``labelled``: tokens and blocked (boolean).  A rule needs ``min_pages``
    blocked pages, whatever the number of pages, and a confidence that reaches
    ``min_confidence`` and is above the share of blocked pages, or one.  Tokens
    that every page or too few blocked pages carry cannot decide and are
    dropped before mining.  A token that is a rule alone is not mined further:
    any longer rule with it would not be minimal."""
    n, blocked = labelled.agg(F.count(F.lit(1)), F.count(F.when(F.col("blocked"), 1))).first()
    if not blocked:
        return labelled.select("tokens", F.lit(0.0).alias("confidence"), F.lit(0.0).alias("support")).limit(0)
    confident = (F.col("confidence") >= min_confidence) & ((F.col("confidence") > blocked / n) | (F.col("confidence") == 1))
    tokens = (
        labelled.select("blocked", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("blocked"), 1)).alias("bad"))
        .where((F.col("bad") >= min_pages) & (F.col("pages") < n))
        .withColumn("confidence", F.col("bad") / F.col("pages"))
    )
    alone = tokens.where(confident).select(F.array("token").alias("tokens"), "confidence", (F.col("bad") / n).alias("support"))
    useful = tokens.where(~confident).select("token")
    kept = (
        labelled.withColumn("page", F.monotonically_increasing_id())
        .select("page", "blocked", F.explode("tokens").alias("token"))
        .join(useful, "token")
        .groupBy("page")
        .agg(F.collect_set("token").alias("tokens"), F.first("blocked").alias("blocked"))
    )
    mark = F.when(F.col("blocked"), F.array(F.lit(BLOCK_ITEM))).otherwise(F.array().cast("array<string>"))
    items = kept.select(F.concat("tokens", mark).alias("items"))
    mined = items.count()
    if not mined:
        return alone
    # Half a page less, so that rounding drops no itemset of min_pages pages.
    share = min(1.0, max(0.0, (min_pages - 0.5) / mined))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(items)
    combined = (
        model.associationRules.where(F.array_contains("consequent", BLOCK_ITEM))
        .where(confident)
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", (F.col("support") * mined / n).alias("support"))
    )
    return alone.union(combined)


def minimal_rules(rules: DataFrame) -> DataFrame:
    """Rules of which no other rule is a part (a part fits whenever they do)."""
    parts = rules.select(F.col("tokens").alias("part"), F.explode("tokens").alias("token"))
    whole = rules.select(F.col("tokens").alias("whole"), F.explode("tokens").alias("token"))
    longer = (
        whole.join(parts, "token")
        .where(F.size("part") < F.size("whole"))
        .groupBy("whole", "part")
        .count()
        .where(F.col("count") == F.size("part"))
        .select(F.col("whole").alias("tokens"))
        .distinct()
    )
    return rules.join(longer, "tokens", "left_anti")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    min_pages: int = 30,
    min_confidence: float = 0.7,
) -> DataFrame:
    """``(id_col, host, path, rule, verdict, mined)``, a row a page row.

    ``labels``: id_col and blocked (boolean; null rows are ignored).  mined is
    the number of mined rules a url fits; a url without a fixed rule is
    blocked if it fits any.  Without labels nothing is mined and such urls are
    allowed.  Repeated ids keep their rows; other columns are not read."""
    url = F.col("url")
    host, path = url_parts(url)
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    base = (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
        .withColumns({"host": host, "path": path})
        .withColumn("tokens", url_tokens(url, F.col("host"), F.col("path")))
    )
    known = labels.where(F.col("blocked").isNotNull()).groupBy(F.col(id_col).alias("page_id")).agg(F.max("blocked").alias("blocked"))
    labelled = base.join(known, "page_id").select("tokens", "blocked")
    mined = minimal_rules(mine_rules(labelled, min_pages, min_confidence))
    # The index: each rule under its rarest token; a url meets only the rules
    # of its own tokens, and the distinct token sets are matched once.
    sets = base.groupBy("tokens").agg(F.count(F.lit(1)).alias("pages"))
    postings = sets.select("tokens", "pages", F.explode("tokens").alias("token"))
    spread = postings.groupBy("token").agg(F.sum("pages").alias("pages"))
    by_rarity = F.min_by("token", F.struct("pages", "token"))
    index = (
        mined.select(F.col("tokens").alias("needs"), F.explode("tokens").alias("token"))
        .join(spread, "token")
        .groupBy("needs")
        .agg(by_rarity.alias("token"))
    )
    fits = (
        postings.join(index, "token")
        .where(F.size(F.array_except("needs", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.count(F.lit(1)).alias("mined"))
    )
    return (
        base.join(fits, "tokens", "left")
        .withColumn("mined", F.coalesce("mined", F.lit(0)).cast("long"))
        .select(
            F.col("page_id").alias(id_col),
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(ruled, F.when(F.col("mined") > 0, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            "mined",
        )
    )
