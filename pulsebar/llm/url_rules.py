"""URL filters by association rules.

Curated rules (host, path) decide first. For the other pages, rules are mined from the labelled pages:
single URL tokens are all counted, however rare, and FP-growth finds the combinations of more tokens that
have enough support. A rule needs ``LEAST`` pages with a low-quality label, and the lower end of its
confidence's Wilson interval must reach ``confidence``, so few pages prove nothing and the size of the table
plays no part. Rules of which no part does as well are held in an inverted index under their rarest token,
and a page with all tokens of a rule is blocked.

Mining runs on Spark over every labelled page, and the index has a row for each mined rule; its size
is measured, not assumed, before Spark picks a join.

Defined cases: a null url or one without ``://`` has an empty host and path, no tokens, and is
allowed; host names compare in lower case (A-Z); repeated rows are judged each; without labels no
rule is mined; an empty table gives none.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsebar.llm.common import ascii_lower, stored

BAD = "#low"
LEAST = 5
#: Of the normal distribution: a two-sided interval of 95 %.
Z = 1.96


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    whole = F.coalesce(url, F.lit(""))
    rest = F.when(whole.contains("://"), F.substring(whole, F.instr(whole, "://") + 3, F.char_length(whole))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    return ascii_lower(host), F.regexp_extract(after, r"^[^?#]*", 0)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: host labels with their place from the right, path words, ending, query names."""
    labels = F.filter(F.reverse(F.split(host, r"\.")), lambda x: x != "")
    named = F.transform(labels, lambda x, k: F.concat(F.lit("h"), k.cast("string"), F.lit(":"), x))
    words = F.filter(F.split(ascii_lower(path), r"[/._-]+"), lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
    ending = F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1)
    query = F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit(r"[?&]([A-Za-z_]+)="), F.lit(1))
    flags = F.array(
        F.when(F.coalesce(url, F.lit("")).startswith("https"), "s:https").otherwise("s:other"),
        F.when(ending != "", F.concat(F.lit("e:"), ascii_lower(ending))),
    )
    found = F.concat(
        named, F.transform(words, lambda x: F.concat(F.lit("p:"), x)), F.array_compact(flags),
        F.transform(query, lambda x: F.concat(F.lit("q:"), ascii_lower(x))),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(found))


def curated(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def surely(hits: Column, uses: Column) -> Column:
    """The lower end of the Wilson interval of hits / uses."""
    share, z2 = hits / uses, Z * Z
    return (share + z2 / (2 * uses) - Z * F.sqrt(share * (1 - share) / uses + z2 / (4 * uses * uses))) / (1 + z2 / uses)


def mine(pages: DataFrame, labels: DataFrame, support: float, confidence: float) -> DataFrame:
    """(antecedent, confidence, support) of pruned rules that end in a low-quality label."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    baskets = pages.join(known, pages.page_id == known.doc_id).select(
        F.when(F.col("quality") == 0, F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items")
    )
    baskets = stored(baskets.where(F.size("items") > 0), "baskets")
    total = baskets.count()
    if total == 0:
        return pages.sparkSession.createDataFrame([], "antecedent array<string>, confidence double, support double")
    # Half a page less keeps rounding from asking for one more.
    model = FPGrowth(itemsCol="items", minSupport=max(support, min(1.0, (LEAST - 0.5) / total)), minConfidence=confidence).fit(baskets)
    several = model.associationRules.where((F.col("consequent") == F.array(F.lit(BAD))) & (F.size("antecedent") > 1)).select(
        F.array_sort("antecedent").alias("antecedent"), F.round(F.col("support") * total).alias("hits"),
        F.round(F.col("support") * total / F.col("confidence")).alias("uses"),
    )
    single = baskets.select(F.explode("items").alias("token"), F.array_contains("items", BAD).cast("double").alias("low"))
    single = single.where(F.col("token") != BAD).groupBy("token").agg(F.sum("low").alias("hits"), F.count("*").cast("double").alias("uses"))
    single = single.select(F.array("token").alias("antecedent"), "hits", "uses")
    proven = single.unionByName(several).where((F.col("hits") >= LEAST) & (surely(F.col("hits"), F.col("uses")) >= confidence))
    rules = stored(proven.select("antecedent", (F.col("hits") / F.col("uses")).alias("confidence"), (F.col("hits") / total).alias("support")), "rules")
    # A rule goes if a part of it is at least as sure; parts are found under each of their tokens.
    wider = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("sure"), F.col("antecedent")[0].alias("token"))
    longer = rules.withColumn("token", F.explode("antecedent"))
    idle = longer.join(wider, "token").where(
        (F.size("part") < F.size("antecedent")) & (F.col("sure") >= F.col("confidence"))
        & (F.size(F.array_except("part", "antecedent")) == 0)
    ).select("antecedent").distinct()
    return rules.join(idle, "antecedent", "left_anti")


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]],
    support: float = 0.002, confidence: float = 0.6,
) -> DataFrame:
    """page_id, host, path, rule, verdict and the mined rule's confidence (``suspicion``)."""
    host, path = parts(F.col("url"))
    read = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    read = read.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    mined = stored(mine(read, labels, support, confidence), "pruned-rules")
    # The index: each rule stands under the one of its tokens that fewest rules have.
    spread = mined.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    rarity = spread.groupBy("token").agg(F.count("*").alias("uses"))
    rarest = Window.partitionBy("antecedent").orderBy("uses", "token")
    index = stored(
        spread.join(rarity, "token").withColumn("nth", F.row_number().over(rarest)).where("nth = 1")
        .select("token", "antecedent", "confidence"),
        "rule-index",
    )
    # Pages with the same tokens are looked up once.
    shapes = read.where(F.size("tokens") > 0).select("tokens").distinct()
    hits = (
        shapes.withColumn("token", F.explode("tokens")).join(index, "token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens").agg(F.max("confidence").alias("suspicion"))
    )
    rule, verdict = curated(F.col("host"), F.col("path"), rules)
    return read.join(stored(hits, "url-hits"), "tokens", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("suspicion").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "suspicion",
    )
