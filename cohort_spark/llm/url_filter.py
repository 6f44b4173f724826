"""Operator 10, URL filters: rules, and the likelihood ratio of two character language models for the rest.

One smoothed variable-order Markov model is learnt from the URLs that rules accept, one from those they reject:
contexts of up to three characters, each order interpolated with the next shorter one in proportion to the number
of different characters that follow the context (Witten-Bell), down to a uniform distribution. A URL scores the
mean log-likelihood difference over its characters; the cut is calibrated on a held-out fifth of the decided URLs.

Characters are folded to 40 symbols, so there are at most 40**4 = 2,560,000 different windows of context and
character, whatever the number of URLs: counts are aggregated per window, the models are computed on that table, and
the scored windows are the one broadcast side. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import checked_broadcast, pick, stage

#: Fixed values: (verdict, host and path) of each rule.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 40  # a-z, 0 for digits, eleven marks, * for the rest, ^ for the start and end
MAX_WINDOWS = SYMBOLS ** 4
FOLD = 5  # one URL in so many (by its checksum) calibrates instead of training
BINS = 500  # calibration bins on either side of 0, of 0.01 each


def _decide(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        h, p = r[:r.index("/")], r[r.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _level(grams: DataFrame, gram: str, context: str) -> tuple[DataFrame, DataFrame]:
    """Counts per gram and per context of one order: occurrences and different followers, for both models."""
    g = grams.groupBy(gram).agg(F.sum("a").alias("a"), F.sum("r").alias("r")).withColumn(
        context, F.expr(f"substring({gram}, 1, length({gram}) - 1)"))
    c = g.groupBy(context).agg(F.sum("a").alias("na"), F.sum("r").alias("nr"),
                               F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
    return g.drop(context), c


def _models(grams: DataFrame) -> DataFrame:
    """Window -> log-likelihood difference in millionths (integers, so that sums don't depend on their order)."""
    out = grams.select("w", "a", "r", *[F.expr(f"substring(w, {5 - k}, {k})").alias(f"g{k}") for k in (1, 2, 3, 4)])
    out = out.withColumn("pa", F.lit(1.0 / SYMBOLS)).withColumn("pr", F.lit(1.0 / SYMBOLS))
    for k in (1, 2, 3, 4):
        g, c = _level(out.select(f"g{k}", "a", "r"), f"g{k}", "ctx")
        g = g.withColumnsRenamed({"a": "ga", "r": "gr"})
        out = out.join(g, f"g{k}").withColumn("ctx", F.expr(f"substring(g{k}, 1, {k - 1})")).join(c, "ctx")
        for m in ("a", "r"):
            n = F.col(f"n{m}") + F.col(f"t{m}")
            out = out.withColumn(f"p{m}", F.when(n > 0, (F.col(f"g{m}") + F.col(f"t{m}") * F.col(f"p{m}")) / n).otherwise(F.col(f"p{m}")))
        out = out.drop("ctx", "ga", "gr", "na", "nr", "ta", "tr")
    return out.select("w", F.round(1e6 * (F.log("pa") - F.log("pr"))).cast("long").alias("llr"))


def _cut(bins: list[tuple[int, int, int]]) -> float:
    """The bin edge with the best balanced accuracy, nearest 0 among equals; 0 if a class is missing."""
    total_a, total_r = sum(a for _, a, _ in bins), sum(r for _, _, r in bins)
    if not total_a or not total_r:
        return 0.0
    best, below_a, below_r, counts = (-1.0, 0, 0), 0, 0, {b: (a, r) for b, a, r in bins}
    for edge in range(-BINS, BINS + 2):  # URLs in bins under the edge are rejected
        a, r = counts.get(edge - 1, (0, 0))
        below_a, below_r = below_a + a, below_r + r
        best = max(best, ((total_a - below_a) * total_r + below_r * total_a, -abs(edge), edge))
    return best[2] / 100


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """One row per page: ``(id, host, path, rule, verdict, score)``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?``, ``#``
    or the end; both empty for a null URL or one without ``://``. A rule fits its host and its subdomains if the path starts
    with the rule's path; the longest fitting rule decides. Other URLs are allowed if their score reaches the calibrated
    cut. ``score`` is the mean log-likelihood difference (accepted minus rejected) per character of what follows ``://`` (of
    the whole URL without one, of the empty text for null). Without decided URLs of both kinds the cut is 0. Repeated rows
    give repeated rows; null ids stay. Columns besides the two named are ignored.
    """
    url = F.col("url")
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    src = pick(pages, id=id_col, url=url_col)
    src = src.withColumn("at", at).withColumn("rest", F.expr("if(at > 0, substring(url, at + 3), '')"))
    src = (src.withColumn("host", F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER))
           .withColumn("path", F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)))
    rule, verdict = _decide(F.col("host"), F.col("path"), rules)
    folded = F.regexp_replace(F.translate(F.expr("if(at > 0, rest, coalesce(url, ''))"), UPPER + "123456789", LOWER + "000000000"),
                              r"[^a-z0./\-_?=&#%~:]", "*")
    src = src.select("id", "url", "host", "path", rule.alias("rule"), verdict.alias("given"),
                     F.concat(F.lit("^^^"), folded, F.lit("^")).alias("padded"),
                     (F.pmod(F.crc32(F.coalesce(url, F.lit(""))), F.lit(FOLD)) == 0).alias("held"))
    windows = (src.withColumn("windows", F.expr("transform(sequence(1, length(padded) - 3), i -> substring(padded, i, 4))"))
               .select("id", "url", "host", "path", "rule", "given", "held", F.posexplode("windows").alias("pos", "w")))
    grams = stage(windows.groupBy("w").agg(F.count_if((F.col("given") == "allow") & ~F.col("held")).alias("a"),
                                           F.count_if((F.col("given") == "block") & ~F.col("held")).alias("r")), "url-grams")
    model = stage(_models(grams), "url-model")
    scored = (windows.join(checked_broadcast(model, limit=MAX_WINDOWS), "w")
              .groupBy("id", "url", "host", "path", "rule", "given", "held")
              .agg(F.count_if(F.col("pos") == 0).alias("copies"), F.count(F.lit(1)).alias("n"), F.sum("llr").alias("llr")))
    scored = stage(scored.withColumn("score", F.col("llr") / F.col("n") / 1e6), "url-scores")
    edge = F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-BINS)), F.lit(BINS)).alias("b")
    bins = (scored.where("held and given is not null").groupBy(edge)
            .agg(F.sum(F.when(F.col("given") == "allow", F.col("copies")).otherwise(0)).alias("a"),
                 F.sum(F.when(F.col("given") == "block", F.col("copies")).otherwise(0)).alias("r")).collect())  # at most 1,001 rows
    cut = _cut([(x["b"], x["a"], x["r"]) for x in bins])
    judged = F.coalesce("given", F.when(F.floor(F.col("score") * 100) >= round(cut * 100), F.lit("allow")).otherwise(F.lit("block")))
    return (scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select(F.col("id").alias(id_col), "host", "path", "rule", judged.alias("verdict"), "score"))

