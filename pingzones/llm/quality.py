"""Document quality by hierarchical empirical Bayes.

A classifier gives each document a probability of being good from its words and
shape.  Hosts, and paths within hosts, have posterior means of that probability:
a host is shrunk toward the global mean and a path toward its host, the more the
fewer documents it has.  The shrinkage is estimated from how much the groups
differ.  A document's posterior odds are its own odds times the ratio of its
site's prior odds to the global ones; its own evidence is taken out of its site's.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pingzones.llm.common import stored
from pingzones.llm.urls import host_and_path

# Labelled documents that the classifier learns from: those of lowest hash.
MAX_LABELLED = 20_000
WORD_FEATURES = 1 << 16
# An absolute penalty, which leaves the few words and shapes that tell.
REGULARISATION = 0.002
# Bounds of the number of documents that a prior weighs as much as.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10_000.0
# Probabilities stay this far from 0 and 1 in odds.
MARGIN = 1e-6
SHAPES = ("upper", "symbols", "digits", "distinct", "length", "amount")


def _features(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.split(F.trim(whole), r"\s+")
    counted = docs.withColumns(
        {
            "_words": words,
            "_seen": F.array_distinct(F.transform(F.array_distinct(words), lambda w: F.regexp_replace(F.lower(w), r"^\W+|[.,;]+$", ""))),
            "_size": F.greatest(F.length(whole), F.lit(1)).cast("double"),
        }
    )
    part = lambda pattern: F.length(F.regexp_replace(whole, pattern, "")) / F.col("_size")
    shapes = {
        "upper": part(r"[^\p{Lu}]+"),
        "symbols": part(r"[\p{L}\p{N}\s]+"),
        "digits": part(r"[^0-9]+"),
        "distinct": F.size("_seen") / F.size("_words"),
        "length": F.log1p(F.col("_size") / F.size("_words")),
        "amount": F.log1p(F.size("_words").cast("double")),
    }
    shaped = counted.withColumns({f"_{k}": v for k, v in shapes.items()})
    hashed = HashingTF(inputCol="_seen", outputCol="_hashed", numFeatures=WORD_FEATURES, binary=True).transform(shaped)
    together = VectorAssembler(inputCols=["_hashed", *(f"_{s}" for s in SHAPES)], outputCol="_features")
    return together.transform(hashed.drop("_words", "_seen"))


def document_scores(docs: DataFrame, labels: DataFrame, text: str, id_: str, sites: dict[str, Column]) -> DataFrame:
    """(doc_id, sites, p): probability of being good, of every row.

    Good means a quality of 1 and not toxic.  Labels with a null are left out, and of
    several labels of one document the worse one counts;
    with one kind of label only, every document has that probability, with none 0.5.
    """
    known = labels.filter("doc_id is not null and quality is not null").select(
        "doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)).cast("double").alias("label")
    )
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED), "quality-labels")
    rows = docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("_text"), *[c.alias(n) for n, c in sites.items()])
    # The documents of at most MAX_LABELLED labels, as often as the optimiser asks for them.
    sample = stored(rows.join(F.broadcast(chosen), "doc_id").select("_text", "label"), "quality-sample")
    s = sample.agg(F.min("label").alias("least"), F.max("label").alias("most")).first()
    if s["least"] == s["most"]:
        alone = 0.5 if s["least"] is None else s["least"]
        return rows.withColumn("p", F.lit(alone)).drop("_text")
    learned = _features(sample, "_text").select("_features", "label").persist()
    model = LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=REGULARISATION, elasticNetParam=1.0, maxIter=40
    ).fit(learned)
    learned.unpersist()
    judged = model.transform(_features(rows, "_text"))
    return judged.select("doc_id", *sites, vector_to_array("probability")[1].alias("p"))


def _shrinkage(groups: DataFrame, mean: float) -> float:
    """How many documents the prior of the groups weighs, by the method of moments.

    ``groups`` has (n, total, squares) of the probabilities in each group.
    """
    of_two = groups.filter("n > 1")
    m = F.col("total") / F.col("n")
    within = (F.col("squares") - F.col("n") * m * m) / (F.col("n") - 1)
    s = of_two.agg(
        F.avg((m - mean) * (m - mean)).alias("spread"), F.avg(within / F.col("n")).alias("noise"),
        F.avg(within).alias("within"),
    ).first()
    if s["spread"] is None:
        return MOST_WEIGHT
    between = s["spread"] - s["noise"]
    weight = MOST_WEIGHT if between <= 0 else s["within"] / between
    return min(MOST_WEIGHT, max(LEAST_WEIGHT, weight))


def _logit(p: Column) -> Column:
    held = F.greatest(F.lit(MARGIN), F.least(F.lit(1 - MARGIN), p))
    return F.ln(held / (1 - held))


def classify(
    docs: DataFrame, labels: DataFrame, pages: DataFrame | None = None, text: str = "text", id_: str = "doc_id",
    source: str = "source", threshold: float = 0.5,
) -> DataFrame:
    """Per document row: doc_id, host, path, p_document, p_host, p_path, score, keep.

    ``pages`` (page_id, url) names the address of documents; its first segment is
    the path.  Of pages with one id the first by url counts.  A document without
    an address has its source as host and no path; a null source is a host of
    its own.  Null and empty texts are judged by their shape; repeated rows each
    get a row; an empty table gives none.  Other columns are not read.
    """
    if pages is not None:
        urls = pages.filter("page_id is not null and url is not null").groupBy("page_id").agg(F.min("url").alias("_url"))
        narrow = docs.select(F.col(id_).alias(id_), F.col(text).alias(text), F.col(source).cast("string").alias(source))
        docs = narrow.join(urls, F.col(id_) == F.col("page_id"), "left")
        host, path = host_and_path(F.col("_url"))
        no_url = F.col("_url").isNull()
        sites = {
            "host": F.when(no_url, F.col(source)).otherwise(host),
            "path": F.when(no_url, "").otherwise(F.regexp_extract(path, "^/[^/]*", 0)),
        }
    else:
        sites = {"host": F.col(source).cast("string"), "path": F.lit("")}
    scores = stored(document_scores(docs, labels, text, id_, sites), "quality-scores")
    # A null host is grouped under a name that is no host.
    keyed = scores.withColumn("_host", F.coalesce("host", F.lit("\x00")))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("total"), F.sum(F.col("p") * F.col("p")).alias("squares")]
    paths = stored(keyed.groupBy("_host", "path").agg(*sums), "quality-paths")
    hosts = stored(
        paths.groupBy("_host").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]), "quality-hosts"
    )
    all_ = hosts.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    mean = all_["total"] / all_["n"] if all_["n"] else 0.5
    host_weight, path_weight = _shrinkage(hosts, mean), _shrinkage(paths, mean)
    by_host = hosts.select("_host", F.col("n").alias("_host_n"), F.col("total").alias("_host_total"))
    by_path = paths.select("_host", "path", F.col("n").alias("_path_n"), F.col("total").alias("_path_total"))
    joined = keyed.join(by_path, ["_host", "path"]).join(by_host, "_host")
    p_host = (host_weight * mean + F.col("_host_total") - F.col("p")) / (host_weight + F.col("_host_n") - 1)
    p_path = (path_weight * F.col("p_host") + F.col("_path_total") - F.col("p")) / (path_weight + F.col("_path_n") - 1)
    posed = joined.withColumn("p_host", p_host).withColumn("p_path", p_path)
    odds = _logit(F.col("p")) + _logit(F.col("p_path")) - _logit(F.lit(mean))
    return posed.withColumn("score", 1 / (1 + F.exp(-odds))).select(
        "doc_id", "host", "path", F.col("p").alias("p_document"), "p_host", "p_path", "score",
        (F.col("score") >= threshold).alias("keep"),
    )
