"""URL filter: a ratio of character models, in DataFrame functions only.

Rules decide some URLs. Two smoothed Markov models of variable order are learned from the
accepted and the rejected ones: the probability of a character after its three
predecessors falls back, by Witten-Bell weights, on shorter and shorter contexts. A URL's
score is the difference of its two log-likelihoods divided by its length. URLs without a
rule are accepted from a threshold on, calibrated for balanced accuracy on a share of the
ruled URLs that the models have not seen.

Characters are folded to `ALPHABET`, so a model has at most 33^4 four-character strings
whatever the input; that bounds the broadcast tables. Counting is combined before the
shuffle, and each different URL counts once, so no host or URL is a hot spot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import checkpointed

#: (action, host, path)
Rule = tuple[str, str, str]
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-?~^"
CONTEXT = 3
#: Histogram bins of the score for one unit.
BINS = 50


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule and its action; NULL where none fits."""
    rule = action = None
    for does, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        action = F.when(fits, F.lit(does)).otherwise(action)
    return rule, action


def folded(url: Column) -> Column:
    """What the models read: the URL after its scheme, in `ALPHABET`, with a start mark."""
    rest = F.lower(F.regexp_replace(F.coalesce(url, F.lit("")), "^[^:/?#]*://", ""))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, "[0-9]", "0"), "[=&#]", "?"), r"[^a-z0/.\-?]", "~")
    return F.concat(F.lit("^" * CONTEXT), plain)


def _grams(text: Column) -> Column:
    size = F.length(text) - CONTEXT
    return F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(text, i, F.lit(CONTEXT + 1))))


def _ratios(counts: DataFrame) -> DataFrame:
    """gram, ratio: log P(last | rest) of the accepted less that of the rejected model."""
    kinds = ("yes", "no")
    level = {CONTEXT: counts}
    for k in range(CONTEXT - 1, -1, -1):
        level[k] = level[k + 1].groupBy(F.substring("gram", 2, k + 1).alias("gram")).agg(*[F.sum(c).alias(c) for c in kinds])
    lower = None
    for k in range(CONTEXT + 1):
        context = F.substring("gram", 1, k).alias("context")
        totals = level[k].groupBy(context).agg(
            *[F.sum(c).alias(f"n_{c}") for c in kinds], *[F.count(F.when(F.col(c) > 0, 1)).alias(f"t_{c}") for c in kinds]
        )
        now = level[k].withColumn("context", context).join(F.broadcast(totals), "context")
        if lower is None:
            now = now.select("*", *[F.lit(1.0 / len(ALPHABET)).alias(f"q_{c}") for c in kinds])
        else:
            now = now.withColumn("shorter", F.substring("gram", 2, k)).join(F.broadcast(lower), "shorter")
        chance = [
            F.when(F.col(f"n_{c}") + F.col(f"t_{c}") == 0, F.col(f"q_{c}"))
            .otherwise((F.col(c) + F.col(f"t_{c}") * F.col(f"q_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}")))
            for c in kinds
        ]
        lower = now.select(F.col("gram").alias("shorter"), *[p.alias(f"q_{c}") for p, c in zip(chance, kinds)])
    return lower.select(F.col("shorter").alias("gram"), (F.ln("q_yes") - F.ln("q_no")).alias("ratio"))


def _threshold(scored: DataFrame) -> DataFrame:
    """One row: the score from which URLs are accepted."""
    bins = scored.where("held").groupBy(F.floor(F.col("score") * BINS).alias("bin")).agg(
        F.count_if(F.col("action") == "allow").alias("yes"), F.count_if(F.col("action") == "block").alias("no")
    )
    # Bins are bounded: a ratio of smoothed chances cannot leave a few dozen units.
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy("bin").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    share = lambda kind: F.try_divide(F.coalesce(F.sum(kind).over(below), F.lit(0)), F.sum(kind).over(whole))
    best = bins.select("bin", F.round(share("no") - share("yes"), 12).alias("gain")).where("gain IS NOT NULL").agg(F.max(F.struct("gain", (-F.col("bin")).alias("low"))).alias("b"))
    return best.select(F.coalesce(-F.col("b.low") / BINS, F.lit(0.0)).alias("threshold"))


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every row of `pages`.

    The verdict is the rule's, else the method's: allow from the threshold on. NULL URLs
    and those without `://` have empty host and path; an empty URL scores 0. Without
    ruled URLs of both kinds all scores fall back on the smoothing and the threshold on 0.
    Equal rules tie in favour of the later one; repeated rows are judged each; other
    columns are not carried; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"), folded(F.col("url")).alias("read"))
    rule, action = ruled(F.col("host"), F.col("path"), rules)
    urls = urls.select("page_id", "host", "path", "read", rule.alias("rule"), action.alias("action"))
    held = F.substring(F.md5("read"), 1, 1).isin("0", "1", "2")

    different = urls.select("read", "action").distinct()
    grams = different.select(F.explode(_grams(F.col("read"))).alias("gram"), (~held & (F.col("action") == "allow")).alias("yes"), (~held & (F.col("action") == "block")).alias("no"))
    counts = checkpointed(grams.groupBy("gram").agg(F.count_if("yes").alias("yes"), F.count_if("no").alias("no")))
    ratios = checkpointed(_ratios(counts))

    def scored(rows: DataFrame, keys: list[str]) -> DataFrame:
        spelled = rows.select(*keys, F.explode_outer(_grams(F.col("read"))).alias("gram"))
        return spelled.join(F.broadcast(ratios), "gram", "left").groupBy(*keys).agg(
            F.round(F.coalesce(F.avg("ratio"), F.lit(0.0)), 9).alias("score"))

    known = different.where("action IS NOT NULL").withColumn("held", held).where("held")
    threshold = _threshold(scored(known, ["read", "action", "held"])).scalar()
    verdict = F.coalesce("action", F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    # Rows are numbered in the scan, which gives the same numbers when a task is run again.
    judged = scored(urls.withColumn("row", F.monotonically_increasing_id()), ["row", "page_id", "host", "path", "rule", "action"])
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
