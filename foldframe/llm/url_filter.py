"""URL filter: domain and path rules, and logistic regression on hashed character n-grams for what no rule decides.

DataFrame functions only. A url's host and path are cut out by string functions; the longest rule that fits decides. For
the others, the character n-grams of host and path (with marks for their start and end) are hashed into ``buckets``; a
url's features are its distinct buckets, scaled to unit length. The weights come from a small labelled table of urls
(``sample`` rows at most, chosen by hash, half of each class where there are as many): accelerated gradient descent on
the mean log loss, each step one aggregate over the labelled rows. Gradients are summed as whole numbers, so the model
does not depend on how the rows are dealt to tasks. Scoring reads the weights from one literal array: no shuffle, no
join, any number of rows of one host.

Defined results: a null url, or one without ``://``, has empty host and path and no rule; it is judged by its (empty)
features, so by the bias. Repeated rows and ids are judged each. Without labelled rows every url that no rule blocks is
allowed; with one class only, the bias says so. Labelled rows with a null url or a null class are not used. An empty
table gives an empty table; other columns are ignored, whatever their names.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ready, written
from .exact_dedup import LOWER, UPPER

#: (verdict, host and path) of the registered query; a rule holds for the host and everything below it.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
# Words of the small labelled table, as general blocklists and directories of sites have them.
JUNK_WORDS = (
    "casino poker slots roulette jackpot betting bets bet gamble lottery bingo win bonus pills pharmacy viagra cialis meds drugstore "
    "cheap discount replica adult porn xxx sex nude escort cams hookup ads adserver banner popup track tracker tracking clicks affiliate "
    "spam linkfarm farm phishing malware warez crack keygen torrent payday loans free prize giveaway clickbait scam").split()
PLAIN_WORDS = (
    "news wiki library museum school college garden kitchen recipe travel history science physics biology music theatre cinema books "
    "reader journal weather maps city river mountain forest ocean health doctor family parents sports football cycling hiking photo "
    "camera design paint craft build home house street market farmers bakery coffee tea bread cheese piano guitar choir dance poem story "
    "letter editor writer report forum help guide manual docs code data research archive gallery north south east west "
    "green blue stone bridge harbour station railway airport").split()
#: Names before a host, shapes of hosts of two words, ends of hosts and paths of the table; a word meets ``MIXES`` of them.
PREFIXES, JOINTS = ("", "www.", "m.", "blog."), ("-", "")
ENDS = ("com", "net", "org", "info", "example.com", "example.net", "example.org")
PATHS = ("/", "/en/{n}", "/de/{n}", "/fr/{n}/", "/es/{n}.html", "/{n}", "/index.html", "/page/{n}/", "/article/{n}.html", "/p/{n}")
MIXES = 24
#: Labelled urls that the fit uses at most.
SAMPLE = 4000
BUCKETS, NGRAMS = 1 << 15, (3, 4)
STEPS, RIDGE = 30, 1e-4
#: Probability from which the method blocks: above even odds, as the labelled table holds more junk than pages do.
CUT = 0.6
_FIXED = float(1 << 40)  # gradients are summed in units of 2^-40


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then to ``?``, ``#`` or the end."""
    def until(text: Column, marks: str) -> Column:
        for mark in marks:
            text = F.substring_index(text, mark, 1)
        return text

    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = until(rest, "/?#")
    return F.translate(host, UPPER, LOWER), until(F.substr(rest, F.char_length(host) + 1), "?#")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule that fits, the one with the longer host of two as long; null where none fits."""
    def fits(rule: str) -> Column:
        h, slash, p = rule.partition("/")
        own = (host == F.lit(h)) | host.endswith("." + h) if h else F.lit(True)
        return own & path.startswith(slash + p)

    order = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r[0], r[1]))
    none = F.lit(None).cast("string")
    return (F.coalesce(*[F.when(fits(r), F.lit(r)) for _, r in order], none),
            F.coalesce(*[F.when(fits(r), F.lit(v)) for v, r in order], none))


def buckets_of(host: Column, path: Column, buckets: int = BUCKETS, ngrams: Sequence[int] = NGRAMS) -> Column:
    """Distinct buckets (from 1) of the character n-grams of host and path, in the order of their first place.

    The text is cut into characters once: taking substrings by place would be quadratic for a very long url."""
    def grams(text: Column, kind: str) -> Column:
        chars = F.regexp_extract_all(F.concat(F.lit("\x02"), text, F.lit("\x03")), F.lit("(?s)(.)"), 1)

        def sized(cs: Column, n: int) -> Column:
            at = F.sequence(F.lit(1), F.greatest(F.size(cs) - (n - 1), F.lit(1)))
            return F.transform(at, lambda i: F.pmod(F.xxhash64(F.lit(kind), *[F.get(cs, i + (k - 1)) for k in range(n)]), F.lit(buckets)) + 1)

        def of(cs: Column) -> Column:
            return F.concat(*[sized(cs, n) for n in ngrams])

        # bound once as the variable of a lambda, so that the characters are not cut out again for every n-gram
        return F.element_at(F.transform(F.array(chars), of), 1)

    return F.array_distinct(F.concat(grams(host, "host"), grams(path, "path")))


def _literal(weights: Sequence[float]) -> Column:
    """The weights as one constant array (folded before execution)."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def _constant(values: Sequence[float], kind: str) -> Column:
    """A constant array (one string to parse, folded before execution)."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def margin(features: Column, weights: Sequence[float]) -> Column:
    """Log-odds of "block": the bias (last of ``weights``), and the features' weights over the square root of their number.

    The weights are one constant array and the bias starts the sum inside the lambda, so the generated code is the same in
    every step of a fit and is compiled once."""
    w = _constant(weights[:-1], "double")
    width = F.sqrt(F.greatest(F.size(features), F.lit(1)))
    return F.aggregate(features, width * F.lit(float(weights[-1])), lambda acc, b: acc + F.element_at(w, b.cast("int"))) / width


def seed_urls(spark: SparkSession, mixes: int = MIXES) -> DataFrame:
    """The small labelled table ``url, blocked``: hosts of one or two junk words, or of one or two plain words (twice as
    many), before the same ends and paths, so that the words of a host tell the classes apart and nothing else does."""
    def pick(values: Sequence[str], salt: int) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("word", "k", F.lit(salt)), F.lit(len(values))) + 1).cast("int"))

    def of(words: Sequence[str], blocked: bool, n: int) -> DataFrame:
        d = spark.range(1, numPartitions=1).select(F.explode(F.array(*map(F.lit, words))).alias("word"))
        d = d.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(n))))
        host = F.when(F.col("k") % 3 == 0, F.col("word")).otherwise(F.concat("word", pick(JOINTS, 1), pick(words, 2)))
        number = F.pmod(F.xxhash64("word", "k"), F.lit(1000)).cast("string")
        return d.select(F.concat(F.lit("https://"), pick(PREFIXES, 3), host, F.lit("."), pick(ENDS, 4), F.replace(pick(PATHS, 5), F.lit("{n}"), number)).alias("url"),
                        F.lit(blocked).alias("blocked"))

    return of(JUNK_WORDS, True, mixes).unionByName(of(PLAIN_WORDS, False, 2 * mixes))


def labelled_sample(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` distinct ``url, blocked`` of a labelled table, those with the smallest hashes of either class.

    The classes are counted first (a sketch of distinct urls), so that the hash cuts the table down to about twice the
    sample before anything is sorted; copies of a url meet in the tasks that read them."""
    half = max(1, sample // 2)
    rows = labelled.select(F.col("url").cast("string").alias("url"), F.col("blocked").cast("boolean").alias("blocked")).dropna()
    order = F.pmod(F.xxhash64("url"), F.lit(1 << 52))
    share = F.lit(0.0)
    for r in rows.groupBy("blocked").agg(F.approx_count_distinct("url").alias("n")).collect():  # two rows at most
        share = F.when(F.col("blocked") == F.lit(r["blocked"]), F.lit(min(1.0, 2.5 * half / max(1, r["n"])))).otherwise(share)
    few = rows.where(order < share * float(1 << 52)).distinct()
    rank = F.row_number().over(Window.partitionBy("blocked").orderBy(order, "url"))
    return few.withColumn("_rank", rank).where(F.col("_rank") <= half).select("url", "blocked")


def fit(labelled: DataFrame, sample: int = SAMPLE, buckets: int = BUCKETS, ngrams: Sequence[int] = NGRAMS, steps: int = STEPS,
        ridge: float = RIDGE) -> list[float]:
    """Weights by bucket, and the bias last: logistic regression on (a sample of) a table ``url, blocked``.

    The curvature of each weight is bounded once from the features; steps follow that bound, with momentum."""
    host, path = url_parts(F.col("url"))
    rows = labelled_sample(ready(labelled), sample)
    rows = rows.select(F.col("blocked").cast("double").alias("y"), buckets_of(host, path, buckets, ngrams).alias("b"))
    rows = written(rows.withColumn("v", 1 / F.sqrt(F.greatest(F.size("b"), F.lit(1)))).coalesce(4), "url-features")
    n = rows.count()
    # the buckets that labelled urls have are numbered anew, so that a step's plan holds no more weights than that
    used = sorted(rows.select(F.explode("b").alias("b")).distinct().agg(F.collect_list("b")).first()[0])
    place = [0] * buckets
    for i, bucket in enumerate(used):
        place[bucket - 1] = i + 1
    rows = written(rows.withColumn("b", F.transform("b", lambda b: F.element_at(_constant(place, "int"), b.cast("int")))), "url-rows") if n else rows
    bias = len(used) + 1

    def summed(each: Column) -> list[float]:
        """Sums by feature over the labelled rows of ``each`` times the feature's value, which is 1 for the bias."""
        d = rows.select(each.alias("e"), "v", F.concat("b", F.array(F.lit(bias))).alias("b"))
        d = d.select("e", "v", F.explode("b").alias("at"))
        x = F.col("e") * F.when(F.col("at") == bias, F.lit(1.0)).otherwise(F.col("v"))
        sums = d.groupBy("at").agg(F.sum(F.round(x * F.lit(_FIXED)).cast("long")).alias("x"))
        out = [0.0] * bias
        for at, total in zip(*sums.agg(F.collect_list("at"), F.collect_list("x")).first()):  # one number for each bucket in use
            out[at - 1] = total / _FIXED
        return out

    w, ahead, since = [0.0] * bias, [0.0] * bias, 1.0
    decay = [ridge] * len(used) + [0.0]
    rate = [1 / (c / (4 * n) + d) for c, d in zip(summed(F.col("v") * F.size("b") + 1), decay)] if n else []  # by the sum of a row's values
    for _ in range(steps if n else 0):
        g = summed(1 / (1 + F.exp(-margin(F.col("b"), ahead))) - F.col("y"))
        new = [a - r * (x / n + d * a) for a, r, x, d in zip(ahead, rate, g, decay)]
        later = (1 + math.sqrt(1 + 4 * since * since)) / 2
        ahead = [b + (since - 1) / later * (b - a) for a, b in zip(w, new)]
        w, since = new, later
    out = [0.0] * (buckets + 1)  # buckets without a labelled url have a weight of 0
    for i, bucket in enumerate(used):
        out[bucket - 1] = w[i]
    out[buckets] = w[-1]
    return out


def url_filter(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id",
               url_col: str = "url", sample: int = SAMPLE, buckets: int = BUCKETS, ngrams: Sequence[int] = NGRAMS,
               steps: int = STEPS, cut: float = CUT) -> DataFrame:
    """One row for each input row: ``id_col, host, path, rule, verdict, p_block``.

    ``labelled`` is a table ``url, blocked``; without it the small table of ``seed_urls`` is taken."""
    urls = ready(pages).select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{url_col}`").cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    labelled = seed_urls(pages.sparkSession) if labelled is None else labelled
    weights = fit(labelled, sample, buckets, ngrams, steps)
    parts = urls.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    odds = margin(buckets_of(F.col("host"), F.col("path"), buckets, ngrams), weights)
    judged = parts.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("_verdict"), (1 / (1 + F.exp(-odds))).alias("p_block"))
    method = F.when(F.col("p_block") > cut, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(id_col, "host", "path", "rule", F.coalesce("_verdict", method).alias("verdict"), "p_block")
