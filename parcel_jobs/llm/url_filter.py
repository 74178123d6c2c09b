"""URL filters: rules by host and path, and boosted trees over lexical features where no rule fits.

A rule fits its host and every subdomain, if the path begins with the rule's; of several, the longest decides. Other URLs
are judged by gradient-boosted trees of Spark's ML library over lengths, depths, shares of digits, entropies, numbers
of parameters and statistics of the host's suffixes, trained from labelled URLs. Everything runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let, written


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


ALLOW, BLOCK = "allow", "block"
#: The rules of the query.
RULES = (
    Rule("org", "/", ALLOW),
    Rule("example.org", "/es/", BLOCK),
    Rule("example.org", "/en/1", BLOCK),
    Rule("com", "/fr/", ALLOW),
    Rule("com", "/de/", BLOCK),
)
#: Words of a host that label a URL as one to block, where no table of labelled URLs is given.
BLOCK_WORDS = ("ads", "adult", "bet", "bets", "betting", "casino", "doubleclick", "gambling", "malware", "phishing", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "tracking", "viagra", "warez", "xxx")
#: Labels of the host, counted from its end, that make up the suffixes with statistics.
SUFFIXES = (1, 2, 3)
_FOLDS = 4


def _lower(c: Column) -> Column:
    """A to Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, in lower case; else empty."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct of rule (host and path) and verdict of the longest rule that fits, or null; of rules as long, that with the longer host, then the last by name."""
    if not rules:
        return F.lit(None).cast("struct<size:int,host:int,rule:string,verdict:string>")
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.struct(F.lit(len(r.host + r.path)).alias("size"), F.lit(len(r.host)).alias("host"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in rules
    ]
    return F.array_max(F.array(*fits))


def entropy(text: Column) -> Column:
    """Bits a character; characters outside ASCII count as one."""
    total = F.length(text)

    def share(shown: Column) -> Column:
        part = lambda c: (total - F.length(F.replace(shown, c, F.lit("")))) / total
        return F.aggregate(F.array_distinct(F.split(shown, "")), F.lit(0.0), lambda bits, c: bits - let(part(c), lambda p: p * F.log2(p)))

    return F.when(total > 0, let(F.regexp_replace(text, r"[^ -~]", "\u00ff"), share)).otherwise(0.0)


def lexical_features(url: Column) -> dict[str, Column]:
    """Name and value of each feature of a URL that needs no other."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = lambda c: F.when(F.length(c) > 0, F.length(F.regexp_replace(c, "[^0-9]", "")) / F.length(c)).otherwise(0.0)
    return {
        "chars": F.length(url), "host_chars": F.length(host), "path_chars": F.length(path), "query_chars": F.length(query),
        "depth": F.regexp_count(path, F.lit("/[^/]")), "host_depth": F.regexp_count(host, F.lit(r"[^.]+")),
        "digits": digits(url), "host_digits": digits(host), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": F.regexp_count(query, F.lit("[^&;]+")), "fragment": url.contains("#").cast("int"),
    }


def _suffixes(host: Column) -> Column:
    """Array of the host's last labels, joined: one for each of SUFFIXES; the whole host where it has fewer."""
    labels = F.split(host, r"\.")
    return F.array(*[F.when(F.size(labels) > k, F.array_join(F.slice(labels, F.lit(-k), F.lit(k)), ".")).otherwise(host) for k in SUFFIXES])


def words_label(url: Column, words: Sequence[str] = BLOCK_WORDS) -> Column:
    """1 if a word of the host, between marks and digits, is one of words, else 0."""
    return F.arrays_overlap(F.split(host_of(url), "[^a-z]+"), F.array(*map(F.lit, words))).cast("int")


class UrlModel:
    """Trees and suffix statistics; score(df) adds the probability of block."""

    def __init__(self, trees, stats: DataFrame | None, prior: float, constant: float | None = None):
        self.trees, self.stats, self.prior, self.constant = trees, stats, prior, constant

    def score(self, rows: DataFrame, url: str) -> DataFrame:
        """rows with column score."""
        if self.constant is not None:
            return rows.withColumn("score", F.lit(self.constant))
        ready = _with_features(rows, F.col(url), self.stats, self.prior, None)
        return self.trees.transform(ready).select(*rows.columns, vector_to_array("probability")[1].alias("score"))


#: How many labelled URLs of the whole a suffix's share starts from.
_PRIOR_ROWS = 1.0


def _with_features(rows: DataFrame, url: Column, stats: DataFrame, prior: float, fold: str | None) -> DataFrame:
    """rows with the vector of features. Of rows in a fold, statistics of suffixes leave that fold out."""
    out = rows.withColumn("suffix", _suffixes(host_of(F.coalesce(url, F.lit("")))))
    names = []
    for i, k in enumerate(SUFFIXES):
        of_k = stats.where(F.col("k") == k).select(F.col("of").alias(f"of_{k}"), F.col("bad").alias(f"bad_{k}"), F.col("n").alias(f"n_{k}"))
        out = out.join(of_k, F.col("suffix")[i] == F.col(f"of_{k}"), "left")
        bad, n = (F.coalesce(F.aggregate(F.col(f"{x}_{k}"), F.lit(0.0), lambda a, b: a + b), F.lit(0.0)) for x in ("bad", "n"))
        if fold:
            bad, n = (whole - F.coalesce(F.get(F.col(f"{x}_{k}"), F.col(fold)), F.lit(0.0)) for whole, x in ((bad, "bad"), (n, "n")))
        out = out.withColumns({f"share_{k}": (bad + _PRIOR_ROWS * prior) / (n + _PRIOR_ROWS), f"rows_{k}": F.log1p(F.greatest(n, F.lit(0.0)))})
        names += [f"share_{k}", f"rows_{k}"]
    own = {name: c.cast("double") for name, c in lexical_features(url).items()}
    return VectorAssembler(inputCols=[*own, *names], outputCol="features").transform(out.withColumns(own))


def train_urls(labelled: DataFrame, most: int | None = None, trees: int = 20, depth: int = 4, seed: int = 7) -> UrlModel:
    """A model of labelled (url, label: 1 to block, 0 to allow).

    Trees and statistics of suffixes come from all distinct URLs; a URL with both labels is one to block. If most is given, they come
    from a sample instead: of each label at most most / 2 distinct URLs, those of the smallest hashes, weighted so that the labels keep
    their shares. Statistics are a row for each suffix, in a written table. Rows without a URL or label are left out. Without
    URLs of one label, all scores are 1 or 0; without any, 0.
    """
    urls = labelled.select(F.col("url").alias("url"), F.col("label").cast("int").alias("label")).where("url is not null and label is not null")
    urls = written(urls.groupBy("url").agg(F.max("label").alias("label")), "labelled-urls")
    totals = {r["label"]: r["n"] for r in urls.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    n = [totals.get(0, 0), totals.get(1, 0)]
    if not all(n):
        return UrlModel(None, None, 0.0, 1.0 if n[1] else 0.0)
    sample = urls.withColumns({"hash": F.xxhash64("url", F.lit(seed)), "weight": F.lit(1.0)})
    if most is not None:
        halves = [sample.where(F.col("label") == label).orderBy("hash", "url").limit(most // 2).withColumn("weight", F.lit(n[label] / min(n[label], most // 2))) for label in (0, 1)]
        sample = halves[0].unionAll(halves[1])
    sample = sample.withColumn("fold", F.pmod("hash", F.lit(_FOLDS)).cast("int"))
    sample = written(sample.sortWithinPartitions("hash", "url"), "url-sample")
    rows = sample.select("label", "weight", "fold", F.posexplode(_suffixes(host_of(F.col("url")))).alias("i", "of"))
    of_fold = lambda c: F.array(*[F.sum(F.when(F.col("fold") == f, c).otherwise(0.0)) for f in range(_FOLDS)])
    stats = rows.withColumn("k", F.get(F.array(*map(F.lit, SUFFIXES)), F.col("i"))).groupBy("k", "of")
    stats = written(stats.agg(of_fold(F.col("weight") * F.col("label")).alias("bad"), of_fold(F.col("weight")).alias("n")), "url-suffixes")
    prior = n[1] / sum(n)
    ready = _with_features(sample, F.col("url"), stats, prior, "fold").select("label", "weight", "features")
    learner = GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, seed=seed, minInstancesPerNode=1, cacheNodeIds=False)
    return UrlModel(learner.fit(ready), stats, prior)


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[Rule] = RULES, threshold: float = 0.5, most: int | None = None) -> DataFrame:
    """One row for each row of pages (page_id, url): page_id, host, path, rule, verdict, score.

    rule is the longest that fits, as host and path, else null, and gives the verdict; otherwise it is block where the trees' score, the
    probability of block, reaches the threshold. Without labelled (url, label), the URLs of pages are labelled by
    words_label: no given table has labels of URLs. A null URL, or one without ://, has empty host and path, fits no rule and is scored
    like others. Repeated rows are judged each; other columns are ignored; an empty table gives no rows.
    """
    pages = pages.select("page_id", "url")
    model = train_urls(pages.select("url", words_label(F.col("url")).alias("label")) if labelled is None else labelled, most)
    scored = model.score(pages, "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    scored = scored.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("score") >= threshold, BLOCK).otherwise(ALLOW)
    return scored.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), F.coalesce("fits.verdict", own).alias("verdict"), "score")
