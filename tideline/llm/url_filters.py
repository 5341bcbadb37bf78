"""URL verdicts: rules first, gradient-boosted trees on lexical features where no rule fits.

The URLs that a rule decides are the labelled ones. Trees are fitted on a bounded sample of them; statistics
of host suffixes come from all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.frames import kept_table


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

FEATURES = [
    "url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digit_ratio", "upper_ratio", "entropy",
    "parameters", "fragment", "secure", "suffix_block_rate", "suffix_rows",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: list[Rule], value) -> Column:
    """``value`` of the longest rule that fits; null if none does."""

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)

    longest = sorted(rules, key=lambda r: len(r.text), reverse=True)
    return reduce(lambda rest, r: F.when(fits(r), F.lit(value(r))).otherwise(rest), reversed(longest), F.lit(None).cast("string"))


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.greatest(F.length(text), F.lit(1))

    def add(total: Column, c: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size
        return total - F.when(share > 0, share * F.log2(share)).otherwise(0.0)

    # A URL of any length has few distinct characters.
    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add)


def lexical(pages: DataFrame) -> DataFrame:
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    size = F.greatest(F.length(url), F.lit(1))
    numbers = {
        "url_length": F.log1p(F.length(url)),
        "host_length": F.length(host),
        "path_length": F.log1p(F.length(path)),
        "depth": _count(path, "/"),
        "labels": _count(host, r"\."),
        "hyphens": _count(host, "-"),
        "digit_ratio": _count(url, "[0-9]") / size,
        "upper_ratio": _count(url, "[A-Z]") / size,
        "entropy": entropy(url),
        "parameters": _count(url, "[&=]"),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": url.startswith("https://").cast("int"),
    }
    return pages.withColumn("suffix", F.element_at(F.split(host, r"\."), -1)).withColumns({k: v.cast("double") for k, v in numbers.items()})


def suffix_statistics(labelled: DataFrame, strength: float = 20.0) -> DataFrame:
    """suffix, its smoothed share of blocked URLs and the log of its labelled rows."""
    n, blocked = F.count("*"), F.sum("label")
    return labelled.groupBy("suffix").agg(
        ((blocked + strength * 0.5) / (n + strength)).alias("suffix_block_rate"), F.log1p(n).alias("suffix_rows")
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule], sample_rows: int = 20_000, trees: int = 10, depth: int = 4, seed: int = 7
) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' probability to block) of each row of ``pages``.

    ``sample_rows`` bounds the labelled rows that the trees are fitted on (by a hash of the URL, so about that
    many). Where the labelled rows have fewer than two verdicts there is nothing to fit: URLs without a rule
    are allowed with a null score. A null URL has an empty host and path; repeated rows give a row each; an
    empty table gives none.
    """
    split = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    ruled = split.withColumns(
        {
            "rule": first_rule(host, path, rules, lambda r: r.text),
            "ruled": first_rule(host, path, rules, lambda r: r.verdict),
        }
    )
    rows = lexical(ruled)
    labelled = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    seen = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked")).first()
    given = ["page_id", "host", "path", "rule"]
    if not 0 < seen["blocked"] < seen["n"]:
        return ruled.select(*given, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))

    suffixes = kept_table(suffix_statistics(labelled), "suffixes")

    def assembled(frame: DataFrame) -> DataFrame:
        known = frame.join(suffixes, "suffix", "left").fillna({"suffix_block_rate": 0.5, "suffix_rows": 0.0})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)

    share = min(1.0, sample_rows / seen["n"])
    sample = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(share * 1_000_000))
    sample = kept_table(assembled(sample).select("features", "label"), "labelled")
    if sample.select("label").distinct().count() < 2:
        return ruled.select(*given, F.coalesce("ruled", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed).fit(sample)
    scored = model.transform(assembled(rows)).withColumn("score", vector_to_array("probability")[1])
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(*given, F.coalesce("ruled", judged).alias("verdict"), "score")
