"""URL filtering: fixed rules first, mined token combinations for the rest.

The labels are the urls that fixed rules judge. What such a rule tests itself implies its
verdict by construction and says nothing of urls beyond its reach, so domains, the rules' own
hosts and paths, and host labels that are seen under one rule's host only are in no mined
rule. DataFrame functions and Spark's FP-growth only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinweave.functions.staging import Staging
from kinweave.llm.common import ASCII_LOWER, ASCII_UPPER, free, others

#: (verdict, host, path): fits the host and its subdomains if the path starts with the rule's.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
LABEL = "verdict="
#: Rows of the rule index, or distinct token sets with their verdicts, that may be joined in memory.
SMALL_INDEX = 20_000


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    u = F.col(url)
    rest = F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, F.lit("://")) + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return pages.withColumn("host", F.translate(host, ASCII_UPPER, ASCII_LOWER)).withColumn("path", path)


def fitting_rule(rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest fixed rule that fits ``host`` and ``path``, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        h = F.col("host")
        fits = ((h == host) | h.endswith(f".{host}")) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: top-level domain, site, labels below it and their words, path parts, extension, query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    below = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 2, F.lit(0)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    kinds = [
        F.array(F.concat(F.lit("top:"), F.substring_index(host, ".", -1)), F.concat(F.lit("site:"), F.substring_index(host, ".", -2))),
        F.transform(below, lambda x: F.concat(F.lit("label:"), x)),
        F.flatten(F.transform(below, lambda x: F.transform(F.filter(F.split(x, "[-_0-9]+"), lambda w: (w != "") & (w != x)), lambda w: F.concat(F.lit("word:"), w)))),
        F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike("[0-9]")), lambda x: F.concat(F.lit("part:"), x)),
        F.array(F.concat(F.lit("ext:"), F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)))),
        F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.substring_index(x, "=", 1))),
    ]
    return F.filter(F.array_distinct(F.concat(*kinds)), lambda x: x.isNotNull() & ~x.endswith(":"))


def telling_tokens(labelled: DataFrame, rules, min_support: float, min_rows: int = 20) -> list[str]:
    """Tokens that a mined rule may hold; ``labelled`` has ``tokens`` and ``rule``.

    They are frequent, so there are at most (tokens of a url) / ``min_support`` of them.
    """
    spark = labelled.sparkSession
    n = labelled.count()
    least = max(min_support * n, min_rows)
    own = spark.createDataFrame([(h, p) for _, h, p in rules], "host string, path string").select(F.explode(tokens(F.lit(""), F.col("host"), F.col("path"))).alias("token")).distinct()
    own = [r.token for r in own.collect()] + [f"label:{x}" for _, h, _ in rules for x in h.split(".")]
    hosts = F.countDistinct(F.substring_index("rule", "/", 1))
    seen = labelled.select("rule", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"), hosts.alias("hosts"))
    fine = ~F.col("token").rlike("^(top|site):") & ~F.col("token").isin(own) & (~F.col("token").startswith("label:") | (F.col("hosts") > 1))
    return sorted(r.token for r in seen.filter((F.col("n") >= least) & fine).collect())


def without_redundant(rules: DataFrame) -> DataFrame:
    """Rules but for those of which some of the parts imply the same verdict as surely."""
    index = rules.select(F.col("rule_id").alias("less"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.size("parts").alias("need"), F.explode("parts").alias("token"))
    own = rules.select("rule_id", "verdict", "confidence", F.size("parts").alias("size"), F.explode("parts").alias("token"))
    met = own.join(index, "token").filter("v = verdict AND c >= confidence AND need < size").groupBy("rule_id", "less").agg(F.count("*").alias("met"), F.first("need").alias("need"))
    return rules.join(met.filter("met = need").select("rule_id").distinct(), "rule_id", "left_anti")


def mine_rules(labelled: DataFrame, min_support: float = 0.02, min_confidence: float = 0.9, min_rows: int = 20) -> DataFrame:
    """``rule_id, parts, verdict, confidence, support`` of token combinations that imply a verdict.

    ``labelled`` has ``tokens`` (distinct) and ``verdict``. All rows count.
    FP-growth prunes by support (a share of rows, and ``min_rows``), so a token that few urls
    hold is in no rule, and the association rules by confidence.
    """
    baskets = labelled.select(F.array_union("tokens", F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    support = min(1.0, max(min_support, min_rows / max(1, baskets.count())))
    rules = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets).associationRules
    return rules.filter((F.size("consequent") == 1) & F.col("consequent")[0].startswith(LABEL) & ~F.exists("antecedent", lambda x: x.startswith(LABEL))).select(
        F.xxhash64(F.array_sort("antecedent"), "consequent").alias("rule_id"), F.array_sort("antecedent").alias("parts"), F.substr(F.col("consequent")[0], F.lit(len(LABEL) + 1)).alias("verdict"), "confidence", "support")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url_key, mined``: the verdict of the surest rule all of whose parts a url holds.

    ``urls`` has ``url_key`` and ``tokens``. The inverted index maps a token to the rules with
    it; a rule fits a url that meets it as often as the rule has parts. Of rules that fit,
    the one with the highest confidence, then support, then most parts, decides.
    """
    index = rules.select("rule_id", "verdict", "confidence", "support", F.size("parts").alias("need"), F.explode("parts").alias("token"))
    if index.count() <= SMALL_INDEX:
        index = F.broadcast(index)
    hits = urls.select("url_key", F.explode("tokens").alias("token")).join(index, "token")
    whole = hits.groupBy("url_key", "rule_id").agg(F.count("*").alias("met"), F.first("need").alias("need"), F.first("verdict").alias("verdict"), F.first("confidence").alias("confidence"), F.first("support").alias("support")).filter("met = need")
    return whole.groupBy("url_key").agg(F.max_by("verdict", F.struct("confidence", "support", "need", "rule_id")).alias("mined"))


def judge(pages: DataFrame, url: str = "url", rules=RULES, default: str = "allow", min_support: float = 0.02, min_confidence: float = 0.9) -> DataFrame:
    """All columns, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block; columns of these names are replaced).

    Urls that a fixed rule fits take its verdict and are the labels; the others take the
    verdict of the surest mined rule that fits, or ``default`` if none does or none is mined. A null url has an empty host
    and path, holds hardly a token and mostly takes the default. Matching runs on distinct
    token sets, so a url that is repeated a million times is matched once.
    """
    stage = Staging(pages.sparkSession, "urls")
    fixed, held, key, mined = free(pages, "_fixed", "_tokens", "_key", "_mined")
    judged = parsed(pages, url).withColumn(fixed, fitting_rule(rules)).withColumn(held, tokens(F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")))
    judged = judged.withColumn(key, F.xxhash64(held))
    verdict = F.col(fixed)["verdict"]
    sets = stage.write(judged.groupBy(F.col(key).alias("url_key"), verdict.alias("verdict")).agg(F.first(held).alias("tokens"), F.count("*").alias("n")), "sets")
    labelled = judged.filter(F.col(fixed).isNotNull()).select(F.col(held).alias("tokens"), verdict.alias("verdict"), F.col(fixed)["rule"].alias("rule"))
    size = sets.agg(F.count("verdict").alias("labelled"), F.count("*").alias("sets")).first()
    telling = telling_tokens(labelled, rules, min_support) if size.labelled else []
    if telling:
        labelled = labelled.withColumn("tokens", F.array_intersect("tokens", F.array(*map(F.lit, telling))))
        mined_rules = stage.write(without_redundant(stage.write(mine_rules(labelled, min_support, min_confidence), "mined")), "rules")
        found = match_rules(sets.filter("verdict IS NULL").select("url_key", "tokens").dropDuplicates(["url_key"]), mined_rules)
    else:
        found = sets.select("url_key", F.lit(None).cast("string").alias("mined")).limit(0)
    found = found.select(F.col("url_key").alias(key), F.col("mined").alias(mined))
    out = judged.join(F.broadcast(found) if size.sets <= SMALL_INDEX else found, key, "left")
    kept = others(pages, "host", "path", "rule", "verdict")
    return out.select(*kept, "host", "path", F.col(fixed)["rule"].alias("rule"), F.coalesce(verdict, F.col(mined), F.lit(default)).alias("verdict"))
