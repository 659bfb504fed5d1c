"""Secret scan with corpus-wide ownership, in SQL functions only.

Patterns give the candidates of each text.  The value of each candidate is
hashed, and the hashes are counted over the corpus by distinct repositories and
owners: a value that several owners hold is a copied example, one that stays
with its owner and looks random is likely a live credential.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pingzones.llm.common import stored

# Fixed values: (kind, pattern, least length of the value).  The value is the
# end of the match.  Matches that are too short are dropped after matching, as
# they keep later ones from starting inside them; of the last two kinds none
# could start there, so their length is part of the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"
KINDS = (
    ("assign", ASSIGN + VALUE, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 18),
    ("hex", r"[0-9a-f]{16,}", 16),
)
LIVE = "live"

# A value held by this many owners or more is a copied example.
EXAMPLE_OWNERS = 3
# A live-looking value has this many different characters, among them a digit
# and a letter, and none of the words that stand for a value.
LEAST_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|sample|changeme|placeholder|dummy|your|xxxx|1234567|abcdef"


def _matches(text: Column) -> Column:
    """Matches of all kinds: (kind, number, gap before the match in code points, match)."""

    def of(i: int, pattern: str) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.transform(
            F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull()),
            lambda x, n: F.struct(F.lit(i).alias("kind"), n.alias("number"), x["gap"].alias("gap"), x["hit"].alias("hit")),
        )

    none = F.array().cast("array<struct<kind:int,number:int,gap:int,hit:string>>")
    return F.concat(*[F.when(text.rlike(p), of(i, p)).otherwise(none) for i, (_, p, _) in enumerate(KINDS)])


def candidates(docs: DataFrame, text: str, repository: Column, owner: Column, id_: str) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id), and base spans (row, kind, start, stop, value, repository, owner)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    scanned = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_).alias("doc_id"),
            repository.cast("string").alias("repository"), owner.cast("string").alias("owner"),
            _matches(whole).alias("found"),
        ),
        "secret-matches",
    )
    each = scanned.select("row", "repository", "owner", F.inline("found"))
    so_far = Window.partitionBy("row", "kind").orderBy("number")
    stop = F.sum(F.col("gap") + F.length("hit")).over(so_far)
    value = F.when(F.col("kind") == 0, F.regexp_replace("hit", "^" + ASSIGN, "")).otherwise(F.col("hit"))
    placed = each.withColumns({"stop": stop, "value": value})
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in KINDS]), F.col("kind") + 1)
    spans = placed.filter(F.length("value") >= least).select(
        "row", "kind", (F.col("stop") - F.length("hit")).alias("start"), "stop", "value", "repository", "owner"
    )
    return scanned.select("row", "doc_id"), stored(spans, "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: distinct repositories and owners that hold it, and its occurrences.

    Occurrences are first combined by (hash, repository, owner), so a value that
    a third of all texts hold costs no more than a row for each holder.
    """
    value = F.sha2("value", 256).alias("hash")
    holders = spans.groupBy(value, "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    by_owner = holders.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repositories"))
    return by_owner.groupBy("hash").agg(
        F.sum("n").alias("occurrences"), F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners")
    )


def _looks_live(value: Column) -> Column:
    varied = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_CHARACTERS
    return varied & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def scan(
    docs: DataFrame, text: str = "text", id_: str = "doc_id", repository: Column | None = None,
    owner: Column | None = None,
) -> DataFrame:
    """Per document row: counts of base spans, their digest, and all spans.

    ``n_live`` counts base spans whose value one or two owners hold and that
    looks random, ``n_example`` those of copied values; each live value adds one
    span ``live:start:end``.  By default the owner is ``source`` and the
    repository its pair with ``lang``; nulls are one owner, or repository, of
    their own.  A null text is empty; repeated rows each get a row; an empty
    table gives none; other columns are not read.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    documents, spans = candidates(docs, text, repository, owner, id_)
    counts = stored(ownership(spans), "secret-owners")
    judged = spans.withColumn("hash", F.sha2("value", 256)).join(counts, "hash").withColumns(
        {
            "example": F.col("owners") >= EXAMPLE_OWNERS,
            "live": (F.col("owners") < EXAMPLE_OWNERS) & _looks_live(F.col("value")),
        }
    )
    name = F.element_at(F.array(*[F.lit(k) for k, _, _ in KINDS], F.lit(LIVE)), F.col("kind") + 1)
    said = F.concat_ws(":", name, F.col("start"), F.col("stop"))
    base = F.struct("start", "kind", "stop", said.alias("said"))
    live_start = F.col("stop") - F.length("value")
    live = F.struct(
        live_start.alias("start"), F.lit(len(KINDS)).alias("kind"), "stop",
        F.concat_ws(":", F.lit(LIVE), live_start, "stop").alias("said"),
    )
    per_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, (k, _, _) in enumerate(KINDS)],
        F.count_if("live").alias("n_live"), F.count_if("example").alias("n_example"),
        F.sort_array(F.collect_list(base)).alias("_base"),
        F.sort_array(F.collect_set(F.when(F.col("live"), live))).alias("_live"),
    )
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: s["said"]))
    digests = per_row.withColumns(
        {"_digest": joined(F.col("_base")), "spans": joined(F.sort_array(F.concat("_base", "_live")))}
    )
    numbers = [*[f"n_{k}" for k, _, _ in KINDS], "n_live", "n_example"]
    return documents.join(digests, "row", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.sha2(F.coalesce("_digest", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
