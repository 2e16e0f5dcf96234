"""Verdicts on page addresses: given host and path rules, then mined association rules.

The given rules decide the addresses they fit, and those verdicts are the labels that FP-growth
learns from: it mines token combinations of labelled addresses that go with a verdict. Rules of
too little confidence or support are pruned, and so is a rule that a shorter one of at least its
confidence covers. Each mined rule is posted under its rarest token; an address is matched through
the postings of its tokens, and the most confident rule that it holds decides.

Addresses give all their tokens, however deep their paths. Before mining, tokens below the support
are dropped, which loses no rule, and tokens that stand in the very same labelled rows become one
class: an address holds a class if it holds any of its tokens. Else a path shared by many addresses
would be mined in all combinations of its segments, every one with the same support and confidence.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import ascii_lower, durable

# The rules given, longest first where they overlap: host, path, verdict
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"  # where no given and no mined rule speaks
MOST_SENT = 50_000  # token classes, of about a hundred bytes
MOST_RULES = 1000  # given rules are tried in one expression; more than this is refused


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, and of the longest fitting rule: rule, rule_verdict (or null).

    Longest is by host and path together, then by path, then by the rule's text.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} given rules")
    host, path = host_and_path(F.col("url"))
    out = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    best = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[1]), r[0] + r[1]))
    rule = verdict = None
    for h, p, v in best:
        fits = (
            ((F.col("host") == h) | F.endswith("host", F.lit(f".{h}")))
            & F.startswith("path", F.lit(p))
        )
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    null = F.lit(None).cast("string")
    return out.withColumn("rule", null if rule is None else rule).withColumn(
        "rule_verdict", null if verdict is None else verdict)


def url_tokens() -> Column:
    """The distinct tokens of an address.

    Top level, domain and whole host, every path segment with its place (digits as 0), the file
    extension, depth, the scheme, whether there is a fragment, and every query key.
    """
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), F.lit(2)), ".")
    parts = F.filter(F.split("path", "/"), lambda p: p != "")
    shape = lambda p: F.regexp_replace(p, r"\d+", "0")
    query = F.regexp_extract("url", r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.filter(
        F.transform(F.split(query, "&"), lambda k: F.regexp_extract(k, r"(?s)^([^=]*)", 1)),
        lambda k: k != "")
    tokens = F.concat(
        F.array(
            F.concat(F.lit("top:"), F.element_at(labels, -1)),
            F.concat(F.lit("domain:"), domain),
            F.concat(F.lit("host:"), F.col("host")),
            F.concat(F.lit("type:"), F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1)),
            F.concat(F.lit("depth:"), F.size(parts).cast("string")),
            F.concat(F.lit("scheme:"), F.regexp_extract("url", r"^([A-Za-z]+)://", 1)),
            F.when(F.contains("url", F.lit("#")), F.lit("fragment")),
        ),
        F.transform(parts, lambda p, i: F.concat(F.lit("at"), (i + 1).cast("string"), F.lit(":"), shape(p))),
        F.transform(keys, lambda k: F.concat(F.lit("key:"), k)),
    )
    return F.array_distinct(F.filter(tokens, lambda t: t.isNotNull()))


def token_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """(token, class) of the tokens that at least min_support of the labelled rows hold.

    labelled: rows of (row, tokens), row a number of its own for each. Tokens of the same rows are
    told by their count and two independent sums over hashes of these rows; the class is the first
    of them in text order. There are at most (tokens of a row, on average) / min_support classes.
    """
    least = min_support * labelled.count()
    held = labelled.select(F.explode("tokens").alias("token"), "row").groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("one"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("two"))
    first = held.where(F.col("n") >= least).groupBy("n", "one", "two").agg(F.collect_list("token").alias("same"))
    return first.select(F.explode("same").alias("token"), F.array_min("same").alias("class"))


def in_classes(rows: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """rows of (key, tokens), key unique, with the classes of their tokens as tokens, sorted.

    Rows without a token of any class are left out. Up to MOST_SENT classes are sent to all tasks, so
    that a token of every address makes no large group; more are joined.
    """
    if classes.count() <= MOST_SENT:
        classes = F.broadcast(classes)
    return (
        rows.select(key, F.explode("tokens").alias("token")).join(classes, "token")
        .groupBy(key).agg(F.array_sort(F.collect_set("class")).alias("tokens"))
    )


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules from rows of (tokens, verdict): posting, tokens, verdict, confidence, support.

    Support and confidence are over all labelled rows; the verdict takes part in mining as one
    more token. A rule is pruned if dropping one of its tokens leaves a rule with the same verdict
    and no less confidence. posting is the rule's rarest token. No labelled rows give no rules.
    A row with k frequent tokens has 2^k combinations: give classes of tokens (token_classes), which
    leaves as many as say different things of the labelled rows.
    """
    mark = "verdict:"
    baskets = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit(mark), F.col("verdict")))).alias("items"))
    model = FPGrowth(
        itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = durable(
        model.associationRules.where(F.startswith(F.col("consequent")[0], F.lit(mark)))
        .where(~F.exists("antecedent", lambda t: F.startswith(t, F.lit(mark))))
        .select(F.array_sort("antecedent").alias("tokens"),
                F.expr(f"substring(consequent[0], {len(mark) + 1})").alias("verdict"),
                "confidence", "support"))
    shorter = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("reach"))
    covered = (
        rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("gone"))
        .withColumn("part", F.array_remove("tokens", F.col("gone")))
        .join(shorter, ["part", "verdict"]).where("reach >= confidence")
        .select("tokens", "verdict").distinct()
    )
    counts = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), "freq")
    postings = (
        rules.select("tokens", "verdict", F.explode("tokens").alias("token")).join(counts, "token")
        .groupBy("tokens", "verdict")
        .agg(F.min(F.struct("freq", "token"))["token"].alias("posting"))
    )
    return rules.join(covered, ["tokens", "verdict"], "left_anti").join(
        postings, ["tokens", "verdict"])


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule that each url's tokens hold: url, mined_verdict, mined_rule, confidence.

    urls: distinct rows of (url, tokens). Best is the most confident, then the longest, then the
    best supported, then the last in text order.
    """
    held = F.size(F.array_except("rule_tokens", "tokens")) == 0
    best = F.max(F.struct(
        "confidence", F.size("rule_tokens").alias("n"), "support",
        F.array_join("rule_tokens", " ").alias("mined_rule"), F.col("verdict").alias("mined_verdict")))
    return (
        urls.select("url", "tokens", F.explode("tokens").alias("posting"))
        .join(rules.withColumnRenamed("tokens", "rule_tokens"), "posting").where(held)
        .groupBy("url").agg(best.alias("best"))
        .select("url", "best.mined_verdict", "best.mined_rule", "best.confidence")
    )


def filter_urls(pages: DataFrame, rules=RULES, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, mined_rule, confidence.

    A null address, or one without ://, has an empty host and path and fits no given rule. Where
    neither a given nor a mined rule speaks, the verdict is DEFAULT and mined_rule is null. A mined
    rule is written with the first token of each of its classes. Rows may repeat and ids may be null: a verdict depends on the address alone. Other columns of pages
    are not read. An empty table gives an empty result.
    """
    known = durable(judged(pages, rules).withColumn("url", F.coalesce("url", F.lit("")))
                    .withColumn("tokens", url_tokens()).withColumn("row", F.monotonically_increasing_id()))
    labelled = known.where("rule is not null")
    classes = durable(token_classes(labelled.select("row", "tokens"), min_support))
    # a row without a frequent token counts in the support of the others
    baskets = labelled.select("row", F.col("rule_verdict").alias("verdict")).join(
        in_classes(labelled.select("row", "tokens"), classes, "row"), "row", "left").select(
        F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens"), "verdict")
    mined = mine(durable(baskets), min_support, min_confidence)
    urls = known.where("rule is null").select("url", "tokens").distinct()
    matched = match(in_classes(urls, classes, "url"), mined)
    return known.join(matched, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", "mined_verdict", F.lit(DEFAULT)).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"),
        F.when(F.col("rule").isNull(), F.col("confidence")).alias("confidence"),
    )
