"""URL filter: rules by host and path, and a classifier for the rest.

Where no rule fits, a logistic regression over hashed character n-grams of host
and path decides; it is trained from a small table of labelled URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingzones.llm.common import stored

GRAM_LENGTHS = (3, 4, 5)
FEATURES = 1 << 16
REGULARISATION = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _grams(text: Column, name: str) -> Column:
    """Character n-grams with marked ends, told apart by the part they come from."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))
    each = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(marked) - k + 1)),
            lambda i, k=k: F.concat(F.lit(name), F.substr(marked, i, F.lit(k))),
        )
        for k in GRAM_LENGTHS
    ]
    return F.concat(*each)


def _features(parts: DataFrame) -> DataFrame:
    with_grams = parts.withColumn("_grams", F.concat(_grams(F.col("host"), "h:"), _grams(F.col("path"), "p:")))
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True)
    return hashing.transform(with_grams).drop("_grams")


class UrlClassifier:
    """Probability that a URL (``host``, ``path``) is to be blocked.

    ``labelled`` has (url, block), ``block`` being 0 or 1; rows with a null are
    left out.  With one label only, that label's value is the probability; with
    none it is 0.
    """

    def __init__(self, labelled: DataFrame):
        host, path = host_and_path(F.col("url"))
        rows = labelled.filter("url is not null and block is not null").select(
            host.alias("host"), path.alias("path"), F.col("block").cast("double").alias("label")
        )
        s = rows.agg(F.min("label").alias("least"), F.max("label").alias("most")).first()
        self.constant = None if s["least"] != s["most"] else s["least"] or 0.0
        if self.constant is None:
            regression = LogisticRegression(
                featuresCol="_features", labelCol="label", regParam=REGULARISATION, standardization=False
            )
            self.model = regression.fit(_features(rows))

    def scored(self, parts: DataFrame) -> DataFrame:
        """``parts`` with ``score``."""
        if self.constant is not None:
            return parts.withColumn("score", F.lit(self.constant))
        judged = self.model.transform(_features(parts))
        return judged.select(*parts.columns, vector_to_array("probability")[1].alias("score"))


def fitting_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, rule, verdict): the longest fitting rule of each row that has one.

    ``rules`` has (host, path, verdict).  Rows meet rules by the host and by what
    follows each of its dots, in an equi-join.  Of rules of one length the
    blocking one wins.
    """
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    named = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict",
        F.concat("host", "path").alias("rule"),
    )
    met = pages.select("row", "path", F.explode(suffixes).alias("rule_host")).join(named, "rule_host")
    fit = met.filter(F.startswith("path", "rule_path"))
    longest = F.max(F.struct(F.length("rule"), F.col("verdict") == "block", "rule", "verdict"))
    return fit.groupBy("row").agg(longest.alias("best")).select("row", "best.rule", "best.verdict")


def judge(
    pages: DataFrame, rules: DataFrame, labelled: DataFrame, url: str = "url", id_: str = "page_id",
    threshold: float = 0.5,
) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict and the classifier's score.

    A null url, or one without ``://``, has an empty host and path and is judged
    by the classifier like any other; repeated rows each get a row; an empty
    table gives none.  Other columns are not read.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_).alias("page_id"), host.alias("host"), path.alias("path")
    )
    scored = stored(UrlClassifier(labelled).scored(parts), "url-scores")
    ruled = scored.join(fitting_rules(scored, rules), "row", "left")
    guess = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "rule", F.coalesce("verdict", guess).alias("verdict"), "score")
