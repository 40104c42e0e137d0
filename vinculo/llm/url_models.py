"""URL filter: host and path rules first, then the ratio of two character language models, with DataFrame functions only.

The urls that a rule accepts train one variable-order Markov model, those that a rule rejects train another, but for a fold
of both that is kept aside. The models read whole urls. Each interpolates orders 0 to ``ORDER`` by Witten-Bell: a context
trusts its own counts as far as it has seen few kinds of followers, and the next shorter context for the rest. A url's
score is the difference of its two log-likelihoods per character; the threshold is the one that best separates the urls
kept aside.

Counts are taken over all urls. Every distinct character n-gram gets its log-ratio once, and the n-grams of the urls are
joined with these: the most frequent, which are few whatever the number of urls, by a broadcast, the others by a shuffle.
Sums are formed in each task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculo.session import staged

ORDER = 4
LETTERS = 256  # the uniform model below order 0 spreads over so many characters
START, END = "\u0002", "\u0003"
FOLDS = 4  # of the labelled urls, one of so many is kept from the models and chooses the threshold
HOT = 10_000  # n-grams that are more than one in so many are broadcast: there can be no more than that
BINS_PER_UNIT, MOST_BINS = 100, 2000  # of the scores the threshold is chosen by

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Urls of a host and its subdomains whose path begins as given."""

    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    place = F.locate("://", url)
    return F.when(place > 0, F.substring(url, place + 3, F.length(url)))


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one; among equally long rules the first."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name) if name is None else name.when(fits, rule.name)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    nothing = F.lit(None).cast("string")
    return (nothing if name is None else name), (nothing if verdict is None else verdict)


def grams(text: Column, order: int = ORDER) -> Column:
    """Every character of a text and its end, each with the ``order`` characters before it, in time linear in the text."""
    letters = F.split(F.concat(F.lit(START * order), text, F.lit(END)), "")
    shifted = [F.slice(letters, F.lit(k + 1), F.length(text) + 1) for k in range(order + 1)]
    spelt = shifted[0]
    for following in shifted[1:]:
        spelt = F.zip_with(spelt, following, lambda gram, letter: F.concat(gram, letter))
    return spelt


def log_ratios(wanted: DataFrame, counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(``gram``, ``ratio``) for each row of ``wanted``: log p(last character | the others), accepted less rejected.

    ``counts`` has (``gram``, ``n_allow``, ``n_block``).
    """
    result = wanted.select("gram", F.lit(1.0 / LETTERS).alias("p_allow"), F.lit(1.0 / LETTERS).alias("p_block"))
    for k in range(order + 1):
        seen = counts.groupBy(F.right("gram", F.lit(k + 1)).alias("tail")).agg(F.sum("n_allow").alias("n_allow"), F.sum("n_block").alias("n_block"))
        contexts = seen.groupBy(F.substring("tail", 1, k).alias("context")).agg(
            F.sum("n_allow").alias("all_allow"),
            F.sum("n_block").alias("all_block"),
            F.count_if(F.col("n_allow") > 0).alias("kinds_allow"),
            F.count_if(F.col("n_block") > 0).alias("kinds_block"),
        )
        tail = F.right("gram", F.lit(k + 1))
        result = result.withColumn("tail", tail).withColumn("context", F.substring(tail, 1, k))
        result = result.join(seen, "tail", "left").join(contexts, "context", "left")
        smoothed = [
            F.when(
                F.col(f"kinds_{side}") > 0,
                (F.coalesce(f"n_{side}", F.lit(0)) + F.col(f"kinds_{side}") * F.col(f"p_{side}")) / (F.col(f"all_{side}") + F.col(f"kinds_{side}")),
            )
            .otherwise(F.col(f"p_{side}"))
            .alias(f"p_{side}")
            for side in ("allow", "block")
        ]
        result = result.select("gram", *smoothed)
    return result.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def kept_aside(url: Column) -> Column:
    """Whether a labelled url is kept from the models: by its MD5, so that repeated urls stay together."""
    return F.conv(F.substring(F.md5(url.cast("binary")), 1, 8), 16, 10).cast("long") % FOLDS == 0


def _threshold(scored: DataFrame) -> int:
    """The bin that separates the labelled urls of ``scored`` best: greatest sum of the shares of accepted urls from it on and of
    rejected ones below. Of equally good ones the lowest, moved halfway to the next lower bin that any labelled url has.
    """
    rows = scored.where("label is not null").groupBy("bin").agg(
        F.count_if(F.col("label") == "allow").alias("allow"), F.count_if(F.col("label") == "block").alias("block")
    )
    bins = {row["bin"]: (row["allow"], row["block"]) for row in rows.collect()}  # at most 2 * MOST_BINS + 1 rows
    allowed, blocked = (sum(pair[i] for pair in bins.values()) for i in (0, 1))
    if not allowed or not blocked:
        return 0
    best, cut, above, below, last = -1, 0, allowed, 0, None
    for place in sorted(bins):
        value = above * blocked + below * allowed
        if value > best:
            best, cut = value, (place + (place if last is None else last) + 1) // 2
        above -= bins[place][0]
        below += bins[place][1]
        last = place
    return cut


def judge(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url", order: int = ORDER) -> DataFrame:
    """(id, ``host``, ``path``, ``rule``, ``verdict``, ``score``) for every row of ``pages``.

    The verdict is the longest fitting rule's; without one ``allow`` if the score, cut to hundredths, reaches the
    threshold, else ``block``. A url that is null, empty or has no ``://`` has an empty host and path; the models judge all
    of it, null as the empty text. Without accepted or without rejected urls among those kept aside the threshold is 0.
    Characters U+0002 and U+0003 in a url count like the marks of start and end. Repeated rows and null or repeated ids stay
    as they are; other columns are ignored. ``rules`` is a short list, part of the plan.
    """
    url = F.col(url_column)
    whole = F.coalesce(url, F.lit(""))
    parts = pages.select(F.col(id_column).alias("id"), whole.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, label = rule_columns(F.col("host"), F.col("path"), rules)
    rows = parts.select("*", rule.alias("rule"), label.alias("label"), kept_aside(F.col("url")).alias("aside"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    taught = F.when(~F.col("aside"), F.col("label")).alias("taught")
    spelt = rows.select("row", taught, F.explode(grams(F.col("url"), order)).alias("gram"))
    counts = spelt.groupBy("gram").agg(
        F.count("*").alias("n"), F.count_if(F.col("taught") == "allow").alias("n_allow"), F.count_if(F.col("taught") == "block").alias("n_block")
    )
    counts = staged(counts, "grams")
    ratios = staged(log_ratios(counts, counts.where("n_allow + n_block > 0"), order), "ratios")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("n") * HOT > total).select("gram"))  # fewer than HOT
    near = spelt.join(F.broadcast(ratios.join(hot, "gram", "left_semi")), "gram")
    far = spelt.join(hot, "gram", "left_anti").join(ratios.join(hot, "gram", "left_anti"), "gram")
    sums = [frame.groupBy("row").agg(F.sum("ratio").alias("ratio"), F.count("*").alias("n")) for frame in (near, far)]
    scores = sums[0].unionByName(sums[1]).groupBy("row").agg((F.sum("ratio") / F.sum("n")).alias("score"))
    limit = F.lit(MOST_BINS)
    place = F.floor(F.round(F.col("score"), 9) * BINS_PER_UNIT).cast("int")
    scored = rows.join(scores, "row").withColumn("bin", F.greatest(-limit, F.least(limit, place)))
    scored = staged(scored, "scores")
    own = F.when(F.col("bin") >= _threshold(scored.where("aside")), "allow").otherwise("block")
    return scored.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("label", own).alias("verdict"), "score")
