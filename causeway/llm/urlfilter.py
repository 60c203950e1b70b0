"""URL filter: character language-model ratio of accepted and rejected URLs, behind host and path rules.

Both models are variable-order Markov models over characters. An order's probability is interpolated
with the next shorter one by the number of different symbols that followed the context
(Witten and Bell), down to a uniform one. Rules label URLs; from these both models are counted, and a
share kept aside calibrates the threshold of the length-normalised log-likelihood difference.

Everything is DataFrame functions. Models are tables of n-grams; the frequent ones, a bounded number,
are broadcast, all others joined, so that ``http`` or a hot host makes no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from causeway.llm.common import least_count, stored
from causeway.session import cut_lineage

ORDER = 4  # characters of context
HOT_GRAMS = 50_000  # n-grams that are broadcast at most
KEPT_ASIDE = 4  # one labelled URL in so many calibrates
BIN = 0.01  # step of the threshold
UNIFORM = 1 / 256
PAD, END = "\u0002", "\u0003"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path up to ``?`` or ``#``; empty where there is none."""
    text = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def apply_rules(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. ``rules`` is a parameter list: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def with_grams(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """Add ``grams``, all runs of order + 1 characters of the padded, lower-cased URL, and ``length``."""
    padded = F.concat(F.lit(PAD * order), F.lower("url"), F.lit(END))
    out = urls.withColumn("_chars", F.split(padded, ""))
    n = F.size("_chars") - order
    grams = F.slice("_chars", F.lit(1), n)
    for k in range(1, order + 1):  # linear in the length: each step appends the next character to all runs
        grams = F.zip_with(grams, F.slice("_chars", F.lit(k + 1), n), lambda a, b: F.concat(a, b))
    return out.select("*", n.alias("length"), grams.alias("grams")).drop("_chars")


def gram_ratios(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, n, ratio): log ratio of the accepted to the rejected model for every n-gram of ``urls``.

    ``urls`` has ``grams`` and ``label``, 1 for accepted and 0 for rejected URLs that train, else null.
    """
    each = urls.select("label", F.explode("grams").alias("gram"))
    full = stored(each.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("r")), "url-grams")
    below = None
    for k in range(order + 1):
        counts = full.groupBy(F.expr(f"right(gram, {k + 1})").alias("gram")).agg(*[F.sum(c).alias(c) for c in "nar"]) if k < order else full
        # a context's group holds at most one row per character
        own = Window.partitionBy(F.expr(f"left(gram, {k})"))
        table = counts.select("*", *[F.sum(c).over(own).alias(f"{c}_total") for c in "ar"],
                              *[F.count_if(F.col(c) > 0).over(own).alias(f"{c}_kinds") for c in "ar"])
        if below is None:
            table = table.withColumns({"pa_less": F.lit(UNIFORM), "pr_less": F.lit(UNIFORM)})
        else:
            table = table.withColumn("less", F.expr(f"right(gram, {k})")).join(below, "less")
        p = {f"p{c}": F.when(F.col(f"{c}_total") > 0, (F.col(c) + F.col(f"{c}_kinds") * F.col(f"p{c}_less"))
                             / (F.col(f"{c}_total") + F.col(f"{c}_kinds"))).otherwise(F.col(f"p{c}_less")) for c in "ar"}
        below = table.select(F.col("gram").alias("less"), "n", p["pa"].alias("pa_less"), p["pr"].alias("pr_less"))
        if k < order:
            below = below.drop("n")
    return below.select(F.col("less").alias("gram"), "n", (F.log("pa_less") - F.log("pr_less")).alias("ratio"))


def url_scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(url, score): mean log ratio per character."""
    ratios = stored(ratios, "url-ratios")
    least = least_count(ratios, HOT_GRAMS)
    hot = F.broadcast(ratios.filter(F.col("n") >= least).select("gram", "ratio"))
    each = urls.select("url", "length", F.explode("grams").alias("gram"))
    frequent = each.join(hot, "gram").groupBy("url", "length").agg(F.sum("ratio").alias("sum"))
    rare = each.join(hot, "gram", "left_anti").join(ratios.filter(F.col("n") < least).select("gram", "ratio"), "gram").groupBy(
        "url", "length").agg(F.sum("ratio").alias("sum"))
    return frequent.unionByName(rare).groupBy("url").agg((F.sum("sum") / F.first("length")).alias("score"))


def calibrate(scored: DataFrame) -> float:
    """Threshold with the best balanced accuracy on (score, label), a multiple of ``BIN``.

    Without rejected rows everything is accepted, else without accepted ones everything is rejected.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("r")).collect()  # scores are logs: few bins
    bins.sort(key=lambda b: b["bin"])
    a, r = sum(b["a"] for b in bins), sum(b["r"] for b in bins)
    if not r or not a:
        return float("-inf") if not r else float("inf")
    best, at, below_a, below_r = -1.0, 0, 0, 0
    for b in bins:  # rows from this bin on are accepted
        worth = (a - below_a) / a + below_r / r
        if worth > best or (worth == best and abs(b["bin"]) < abs(at)):
            best, at = worth, b["bin"]
        below_a, below_r = below_a + b["a"], below_r + b["r"]
    if below_r / r > best:
        at = bins[-1]["bin"] + 1
    return at * BIN


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) per row of ``pages``.

    The verdict is that of the longest fitting rule; without one it is ``allow`` if the URL's score reaches the
    calibrated threshold, else ``block``; ``score`` is null for URLs that a rule judges. A URL counts once for the
    models however often it occurs. Null URLs are empty ones. Without rejected examples everything
    left is allowed. Repeated page_ids are separate rows; other columns are not read; an empty table gives
    no rows.
    """
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    urls = rows.select("url").distinct()
    host, path = host_and_path(F.col("url"))
    _, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    aside = F.pmod(F.xxhash64("url"), F.lit(KEPT_ASIDE)) == 0
    known = urls.withColumns({"host": host, "path": path}).withColumn("mark", F.when(verdict == "allow", 1).when(verdict == "block", 0))
    urls = cut_lineage(known.select("url", "mark", F.when(~aside, F.col("mark")).alias("label")))
    grams = with_grams(urls, order)
    scored = cut_lineage(url_scores(grams.filter("mark IS NULL OR label IS NULL"), gram_ratios(grams, order)))
    labelled = scored.join(urls.filter("mark IS NOT NULL").select("url", F.col("mark").alias("label")), "url")
    least = calibrate(labelled)
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    out = rows.withColumns({"host": host, "path": path}).withColumns({"rule": rule, "verdict": verdict})
    chosen = out.join(scored.join(urls.filter("mark IS NULL").select("url"), "url", "left_semi"), "url", "left")
    return chosen.select("page_id", "host", "path", "rule", F.coalesce(
        "verdict", F.when(F.col("score") >= F.lit(least), "allow").otherwise("block")).alias("verdict"), "score")
