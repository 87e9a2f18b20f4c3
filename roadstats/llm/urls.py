"""URL filters by association rules mined with Spark's FP-growth.

A URL is a set of tokens: the labels of its host, its path segments (digit runs as ``#``), file
ending, query names and whether it has a fragment. Labelled pages are transactions of these tokens
plus ``verdict:block`` for rejected pages; FP-growth finds frequent token sets, and the rules
{tokens} -> verdict:block are pruned by support, by the lower end of the 95 % interval of their
confidence (so that a few pages do not make a rule; one formula at every size) and by lift. A rule that
only narrows another one of no less confidence is dropped. Rules are applied through an inverted index: each
stands under its rarest token, so a URL only meets rules of tokens it has, and each meeting is
verified against the whole antecedent.

Pages have no labels of their own: ``page_labels`` reads each page's text out of its HTML and judges it
by the quality and toxicity models, fitted on the labelled documents. Quality 0 or toxic 1 rejects.
Fixed host and path rules come first; the mined ones judge the rest.

Mining and matching run over distinct URLs' tokens, so a URL or host with many pages costs no
more than one. The rules are broadcast only while they are at most ``MOST_BROADCAST``; beyond
that the index is joined by shuffle.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule and
verdict allow. Repeated pages each get their row; a repeated id has the worst of its labels. A page
without HTML or text has no label. Without labels nothing is mined and the rest is allowed. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.llm import quality, toxicity
from roadstats.llm.folds import one_label
from roadstats.session import new_work_dir

#: (verdict, host, path): fixed values of the contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK = "verdict:block"
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.002, 0.5, 1.5
#: Normal quantile of a 95 % interval.
Z = 1.96
MOST_BROADCAST = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fixed rule that fits: struct<rule, verdict>, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, site, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones override
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(site + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL, sorted; none without ``://``."""
    host, path = host_of(url), path_of(url)
    tag = lambda mark, values: F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(mark), v))
    shape = F.regexp_replace(path, r"[0-9]+", "#")
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda q: F.regexp_extract(q, r"^[^=]*", 0))
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    fragment = F.when(after_scheme(url).contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    every = F.concat(
        tag("host:", F.split(host, r"\.")), tag("path:", F.split(shape, "/")), tag("query:", names), tag("ending:", F.array(ending)), fragment
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(every)))


#: Elements whose contents are no text, and those that part it (fixed values).
_HIDDEN = r"(?is)<(script|style|nav)\b.*?</\1\s*>"
_BLOCKS = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|table|title|article|section|header|footer)\b[^>]*>"
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def page_text(html: Column) -> Column:
    """The text of a page: without scripts, styles, menus, comments and tags."""
    text = F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCKS, "\n"), r"<[^>]*>", "")
    for entity, char in _ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(text, r"[ \t]*\n\s*", "\n"), r"^\s+|\s+$", "")


def page_labels(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, toxic) of the pages (page_id, html) that have text, ``doc_id`` being the page's
    id, by models fitted on the labelled documents outside fold 2."""
    texts = pages.select(F.col("page_id").cast("bigint").alias("doc_id"), page_text(F.col("html")).alias("text")).where("text != ''")
    worth = quality.fit(docs, quality.ratings_of(labels))
    harm = toxicity.fit(docs, labels)
    valued = harm.with_ratio(texts.withColumn("value", worth.value("text")), "text", "ratio")
    return valued.select(
        "doc_id",
        (worth.tail(F.col("value")) >= 0.5).cast("int").alias("quality"),
        (harm.probability(F.col("ratio")) >= toxicity.THRESHOLD).cast("int").alias("toxic"),
    )


def least_confidence(share: Column, rows: Column) -> Column:
    """Lower end of the Wilson interval of a share among ``rows``."""
    near = share + Z * Z / 2 / rows - Z * F.sqrt((share * (1 - share) + Z * Z / 4 / rows) / rows)
    return near / (1 + Z * Z / rows)


def mine(transactions: DataFrame, min_support: float, min_confidence: float, min_lift: float) -> DataFrame:
    """(rule, key, confidence): antecedents of verdict:block, and each one's rarest token.

    ``transactions`` has (tokens, blocked).
    """
    items = transactions.select(F.when(F.col("blocked"), F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items"))
    items = items.where(F.size("items") > 0)
    n = max(1, items.count())
    # Fewer rejected pages than this never reach the confidence, even if all are: no rule is lost.
    least = math.ceil(min_confidence * Z * Z / (1 - min_confidence)) if min_confidence < 1 else n
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, least / n)), minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.array_contains("consequent", BLOCK) & (F.col("lift") >= min_lift))
    rules = rules.where(least_confidence(F.col("confidence"), F.col("support") * n / F.col("confidence")) >= min_confidence)
    rules = rules.select(F.array_sort("antecedent").alias("rule"), "confidence")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    ranked = rules.select("rule", "confidence", F.explode("rule").alias("token")).join(single, "token")
    keyed = ranked.groupBy("rule", "confidence").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    # A rule goes if dropping one of its tokens leaves a rule of no less confidence.
    shorter = keyed.select("rule", "confidence", F.explode("rule").alias("out"))
    shorter = shorter.select("rule", "confidence", F.array_remove("rule", F.col("out")).alias("part"))
    wider = rules.select(F.col("rule").alias("part"), F.col("confidence").alias("wider"))
    narrow = shorter.join(wider, "part").where("wider >= confidence").select("rule").distinct()
    return keyed.join(narrow, "rule", "left_anti").select("rule", "key", "confidence")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, confidence): the most confident mined rule that each distinct URL meets."""
    few = rules.count() <= MOST_BROADCAST
    tokens = urls.select("url", tokens_of(F.col("url")).alias("tokens")).select("url", "tokens", F.explode("tokens").alias("key"))
    meetings = tokens.join(F.broadcast(rules) if few else rules, "key").where(F.size(F.array_except("rule", "tokens")) == 0)
    best = F.max_by(F.struct("rule", "confidence"), F.struct("confidence", F.array_join("rule", " ")))
    return meetings.groupBy("url").agg(best.alias("best")).select("url", "best.*")


def judge(
    pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule) of every page."""
    rejected = labels.select("doc_id", F.greatest((F.col("quality") == 0).cast("int"), (F.col("toxic") > 0).cast("int")).alias("bad"))
    known = one_label(rejected, "bad").withColumnRenamed("doc_id", "page_id")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url")
    transactions = rows.join(known, "page_id").select(tokens_of(F.col("url")).alias("tokens"), (F.col("label") > 0).alias("blocked"))
    root = new_work_dir(pages.sparkSession, "url-rules")
    mine(transactions, min_support, min_confidence, min_lift).write.parquet(root)
    rules = pages.sparkSession.read.parquet(root)
    mined = matched(rows.where("url IS NOT NULL").select("url").distinct(), rules)
    judged = rows.join(mined, "url", "left")
    host, path = F.coalesce(host_of(F.col("url")), F.lit("")), F.coalesce(path_of(F.col("url")), F.lit(""))
    judged = judged.select("page_id", host.alias("host"), path.alias("path"), F.array_join(F.col("rule"), " ").alias("mined_rule"))
    fixed = fixed_rule(F.col("host"), F.col("path"))
    method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    judged = judged.withColumn("fixed", fixed)
    return judged.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", method).alias("verdict"), "mined_rule"
    )


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs, labels = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("pages", "documents", "labels"))
    pages = pages.select("page_id", "url", "html")
    return judge(pages, page_labels(pages, docs.select("doc_id", "text"), labels.select("doc_id", "quality", "toxic")))
