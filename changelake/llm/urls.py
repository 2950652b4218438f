"""URL filter: host and path rules, and character language models for the rest.

A rule is a host and a path. It fits its host and every subdomain if the url's
path starts with the rule's path; of several the longest counts. Urls that a
rule decides train two smoothed variable-order Markov models over characters,
one of accepted and one of rejected urls; all other urls are judged by the
models' log-likelihood difference per character.

Model: url text is the host and path, with padding in front. The probability of a character after its last k characters is
Witten-Bell interpolated from order 0 up to ``order``; an order takes part where
training saw that string in either class, so the context length varies. The
threshold is calibrated: one part in five of the distinct training texts is left
out of the counts, and the cut lies where both classes' left-out scores are
equally many standard deviations from their means.

Everything is DataFrame expressions: texts are reduced to distinct ones, their
strings counted, and counts joined by shuffle, so nothing depends on a model
fitting one machine. Defined results: a null url or one without ``://`` has
empty host and path and no rule; empty texts, and all texts while either class
has no training text, score 0; with nothing to calibrate the threshold is 0 and
a score at the threshold or above is allowed. Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, with_row

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
PAD = "^"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host A-Z lower-cased; both empty without ``://``."""
    at = F.instr(url, F.lit("://"))
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*+)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (F.when(at > 0, lowered).otherwise(""), F.when(at > 0, path).otherwise(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer ones go around
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def model_text(host: Column, path: Column) -> Column:
    return F.concat(host, path)


def _strings(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """(keep..., gram, times): the strings of ``order`` + 1 characters that end
    at each character of the text, counted per text."""
    padded = F.concat(F.lit(PAD * order), F.col("text"))
    spots = F.sequence(F.lit(1), F.char_length("text"))
    grams = F.transform(spots, lambda i: F.substr(F.col("padded"), i, F.lit(order + 1)))
    return (texts.where(F.char_length("text") > 0).withColumn("padded", padded)
            .select(*keep, F.explode(grams).alias("gram"))
            .groupBy(*keep, "gram").agg(F.count("*").alias("times")))


def score_texts(texts: DataFrame, order: int = 4) -> DataFrame:
    """(text, score) for distinct ``texts(text, allowed, blocked)``: the flags
    say which class a text trains, both null or false for none."""
    stash = Stash(texts.sparkSession, "urls")
    fold = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(5))
    texts = stash.put(texts.withColumn("learn", fold != 0))
    grams = stash.put(_strings(texts, order, "text", "allowed", "blocked", "learn"))
    a = F.sum(F.when(F.col("learn"), F.col("allowed") * F.col("times")).otherwise(0))
    b = F.sum(F.when(F.col("learn"), F.col("blocked") * F.col("times")).otherwise(0))
    whole = stash.put(grams.groupBy("gram").agg(a.alias("a"), b.alias("b")))
    # Counts of every suffix: context (all but the last character) and character.
    tails = F.transform(F.sequence(F.lit(0), F.lit(order)), lambda k: F.struct(
        k.alias("k"), F.right(F.col("gram"), k + 1).alias("tail")))
    each = whole.select("gram", "a", "b", F.explode(tails).alias("t")).select("gram", "a", "b", "t.k", "t.tail")
    seen = stash.put(each.groupBy("k", "tail").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
                     .where("a > 0 or b > 0"))
    context = F.substr(F.col("tail"), F.lit(1), F.col("k"))
    totals = seen.groupBy("k", context.alias("context")).agg(
        F.sum("a").alias("na"), F.count_if(F.col("a") > 0).alias("ta"),
        F.sum("b").alias("nb"), F.count_if(F.col("b") > 0).alias("tb"))
    model = seen.withColumn("context", context).join(totals, ["k", "context"]).select(
        "k", "tail", "a", "na", "ta", "b", "nb", "tb")
    found = each.select("gram", "k", "tail").join(model, ["k", "tail"], "left")
    orders = F.array_sort(F.collect_list(F.struct("k", "a", "na", "ta", "b", "nb", "tb")))

    def fold_in(n, total, kinds):
        # Order 0 starts from an even guess; an order without counts changes nothing.
        def step(p, x):
            return F.when(x[total].isNull() | (x[total] == 0), p).otherwise(
                (x[n] + x[kinds] * p) / (x[total] + x[kinds]))
        return F.aggregate("o", F.lit(1.0 / 256), step)

    ratio = (found.groupBy("gram").agg(orders.alias("o"))
             .select("gram", (F.log(fold_in("a", "na", "ta")) - F.log(fold_in("b", "nb", "tb"))).alias("ratio")))
    ratio = stash.put(ratio)   # then AQE can split a string that very many urls have
    total = (grams.select("text", "gram", "times").join(ratio, "gram")
             .groupBy("text").agg(F.sum(F.col("times") * F.col("ratio")).alias("sum")))
    classes = texts.where("learn").agg(F.max("allowed"), F.max("blocked")).first()
    mean = F.coalesce(F.col("sum") / F.char_length("text"), F.lit(0.0)) if all(classes) else F.lit(0.0)
    scored = texts.join(total, "text", "left").withColumn("score", mean)
    return scored.select("text", "allowed", "blocked", "learn", "score")


def threshold(scored: DataFrame) -> float:
    """The cut: equally many deviations from both left-out means."""
    out = scored.where(~F.col("learn"))

    def of(flag, f):
        return f(F.when(F.col(flag) > 0, F.col("score")))
    s = out.agg(of("allowed", F.avg).alias("ma"), F.coalesce(of("allowed", F.stddev_pop), F.lit(0.0)).alias("sa"),
                of("blocked", F.avg).alias("mb"), F.coalesce(of("blocked", F.stddev_pop), F.lit(0.0)).alias("sb"))
    spread = F.col("sa") + F.col("sb")
    cut = F.when(spread > 0, (F.col("ma") * F.col("sb") + F.col("mb") * F.col("sa")) / spread).otherwise(
        (F.col("ma") + F.col("mb")) / 2)
    return float(s.select(F.coalesce(cut, F.lit(0.0)).alias("cut")).first()[0])


def judge(pages: DataFrame, rules=RULES, order: int = 4, id_col: str = "page_id",
          url: str = "url") -> DataFrame:
    """(_row, page_id, host, path, rule, verdict, score, cut) for every row."""
    stash = Stash(pages.sparkSession, "url-rows")
    host, path = split_url(F.col(url))
    rows = with_row(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url")))
    rows = rows.select("_row", "page_id", F.coalesce(host, F.lit("")).alias("host"),
                       F.coalesce(path, F.lit("")).alias("path"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    rows = stash.put(rows.select("*", rule.alias("rule"), ruled.alias("ruled"),
                                 model_text(F.col("host"), F.col("path")).alias("text")))
    texts = rows.groupBy("text").agg(F.max((F.col("ruled") == "allow").cast("int")).alias("allowed"),
                                     F.max((F.col("ruled") == "block").cast("int")).alias("blocked"))
    texts = texts.select("text", F.coalesce("allowed", F.lit(0)).alias("allowed"),
                         F.coalesce("blocked", F.lit(0)).alias("blocked"))
    scored = stash.put(score_texts(texts, order))
    cut = F.lit(threshold(scored))
    return rows.join(scored.select("text", "score"), "text").select(
        "_row", "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(
            F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score", cut.alias("cut"))
