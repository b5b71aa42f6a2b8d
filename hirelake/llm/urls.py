"""Operator 8: URL filters by rules, and by gradient-boosted trees where no rule fits.

Everything is DataFrame expressions and MLlib; no Python runs on the executors. The URLs
that a rule fits are the labelled ones; trees learn from their lexical features.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.session import stage

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_entropy", "path_entropy",
            "parameters", "suffix_block_rate", "suffix_log_count"]
#: Weight of the overall rate in a suffix's block rate, in URLs.
SUFFIX_PRIOR = 20.0


class Rule(NamedTuple):
    """A verdict for ``host/path``: the host and all its subdomains, paths that start with the rule's."""

    verdict: str
    where: str


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of its ``verdict`` and ``where``; null if none fits.

    Of equally long rules the first given wins. The rules become one expression, so they are for a list of
    tens or hundreds, which a caller writes by hand.
    """
    out = F.lit(None).cast("struct<verdict:string,where:string>")
    for rule in sorted(rules, key=lambda rule: len(rule.where)):
        name, _, rest = rule.where.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.where).alias("where"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits; 0 for the empty text."""
    size = F.length(text)
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda x: size - F.length(F.replace(text, x, F.lit(""))))
    weighted = F.aggregate(counts, F.lit(0.0), lambda total, n: total + F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(0.0))
    return F.when(size > 0, F.log2(size.cast("double")) - weighted / size).otherwise(0.0)


def _occurrences(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def with_lexical_features(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``, ``host``, ``path``) and the features that need nothing but the URL, and its ``suffix``."""
    url = F.coalesce("url", F.lit(""))
    size = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns({
        "url_length": size,
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": _occurrences(F.col("path"), "/"),
        "labels": _occurrences(F.col("host"), "."),
        "digit_ratio": F.length(F.regexp_replace(url, r"[^0-9]", "")) / F.greatest(size, F.lit(1.0)),
        "host_entropy": _entropy(F.col("host")),
        "path_entropy": _entropy(F.col("path")),
        "parameters": F.when(F.length(query) > 0, _occurrences(query, "&") + 1).otherwise(0.0),
        "suffix": F.substring_index("host", ".", -1),
    })


def _with_suffixes(urls: DataFrame, suffixes: DataFrame, rate: float) -> DataFrame:
    joined = urls.join(F.broadcast(suffixes), "suffix", "left")
    return joined.withColumns({"suffix_block_rate": F.coalesce("suffix_block_rate", F.lit(rate)),
                               "suffix_log_count": F.coalesce("suffix_log_count", F.lit(0.0))})


def judge_urls(df: DataFrame, rules: Sequence[Rule], sample: int = 20000, trees: int = 20, depth: int = 4, seed: int = 11,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` and ``block_score`` of every row.

    The verdict is the rule's, else that of trees trained on the distinct URLs that rules fit: of more than ``sample`` of
    them, about that many are drawn by a hash of the URL, a bound whatever the input. So the statistics per suffix
    also have at most that many rows and are broadcast. ``block_score`` is the trees' probability of ``block``.
    If the labelled URLs have one verdict only, that is everyone's (score 0 or 1); if there are none, all are allowed.

    A null URL or one without ``://`` has an empty host and path and fits no rule; the trees judge it. One
    row per input row, repeated rows and null ids included; an empty table gives no rows. Other columns are not read.
    """
    urls = df.select(df[id_col].alias("page_id"), df[url_col].cast("string").alias("url"))
    urls = urls.withColumns({"host": host_of(F.coalesce("url", F.lit(""))), "path": path_of(F.coalesce("url", F.lit("")))})
    urls = urls.withColumn("fits", rule_of(F.col("host"), F.col("path"), rules))
    urls = urls.select("page_id", "url", "host", "path", F.col("fits.where").alias("rule"), F.col("fits.verdict").alias("ruled"))
    # A URL teaches once, with the logarithm of its rows as weight, however often it is there.
    labelled = urls.where("rule is not null").groupBy("url", "host", "path", "ruled").agg(F.count("*").alias("rows")).select(
        "url", "host", "path", (F.col("ruled") == BLOCK).cast("double").alias("label"), F.log1p("rows").alias("weight"))
    counts = {row["label"]: row["count"] for row in labelled.groupBy("label").count().collect()}
    out = ["page_id", "host", "path", "rule"]
    if len(counts) < 2:
        score = next(iter(counts), 0.0)
        return urls.select(*out, F.coalesce("ruled", F.lit(BLOCK if score else ALLOW)).alias("verdict"), F.lit(score).alias("block_score"))

    parts = 1 << 20
    drawn = F.pmod(F.xxhash64("url"), F.lit(parts)) < min(parts, -(-parts * sample // sum(counts.values())))
    learnt = stage(with_lexical_features(labelled.where(drawn)), "labelled-urls")
    rate = counts[1.0] / sum(counts.values())
    suffixes = stage(learnt.groupBy("suffix").agg(
        ((F.sum("label") + F.lit(SUFFIX_PRIOR * rate)) / (F.count("*") + F.lit(SUFFIX_PRIOR))).alias("suffix_block_rate"),
        F.log1p(F.count("*")).alias("suffix_log_count")), "suffixes")
    model = _fit(_with_suffixes(learnt, suffixes, rate), trees, depth, seed)
    judged = model.transform(_with_suffixes(with_lexical_features(urls), suffixes, rate))
    verdict = F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)
    return judged.select(*out, F.coalesce("ruled", verdict).alias("verdict"),
                         F.get(vector_to_array("probability"), 1).alias("block_score"))


def _fit(learnt: DataFrame, trees: int, depth: int, seed: int) -> PipelineModel:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    boosted = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=trees, maxDepth=depth, seed=seed, maxBins=64)
    rows = assembler.transform(learnt).select("features", "label", "weight").coalesce(4)  # a bounded sample: few tasks, many small rounds
    return PipelineModel([assembler, boosted.fit(rows)])
