"""Registered queries of the operators, and their checking SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pingzones.llm import audit, decontaminate, language, mixing, pieces, prefixes, quality, repeats, secrets, sharding
from pingzones.llm import simhash, topk, urls
from pingzones.llm.url_labels import labelled_urls

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
# (host, path, verdict) of the URL rules.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source", "copies")


def op2_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    labelled = spark.createDataFrame(labelled_urls(), "url string, block int")
    return urls.judge(table(spark, sf_dir, "pages"), rules, labelled)


def op3_site_quality(spark, sf_dir):
    docs, labels, pages = (table(spark, sf_dir, t) for t in ("documents", "labels", "pages"))
    return quality.classify(docs, labels, pages)


def op4_benchmark_index(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = language.identify(docs.withColumn("held_out", language.held_out()), language.train(docs), carry=["doc_id", "held_out"])
    return judged.select("doc_id", "held_out", "lang_pred", "score")


def op6_ball_tree_topk(spark, sf_dir):
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), 64.0)
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


def op7_byte_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    # Only what the digest needs goes along; the texts stay where they are.
    return sharding.contiguous_shards(docs, SHARDS, carry=["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_simhash_groups(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_secret_owners(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_repeated_bytes(spark, sf_dir):
    cut = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversation_trie(spark, sf_dir):
    return prefixes.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def piece_model_path() -> str:
    """The vocabulary file that the machine has; the operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_piece_codec(spark, sf_dir):
    model = pieces.load_model(piece_model_path())
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, model, carry=["doc_id"], decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_source_mix,
        op2_url_filter,
        op3_site_quality,
        op4_benchmark_index,
        op5_language,
        op6_ball_tree_topk,
        op7_byte_shards,
        op8_simhash_groups,
        op9_secret_owners,
        op10_repeated_bytes,
        op11_conversation_trie,
        op12_filter_audit,
        op13_piece_codec,
    )
}

ORACLES: dict[str, str] = {
    "op6_ball_tree_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 20""",
    "op4_benchmark_index": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        starts AS (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, w[s:s + 9] AS p, len(w[s:s + 9]) AS n FROM starts),
        lengths AS (SELECT DISTINCT n FROM windows),
        places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n),
        found AS (
            SELECT r, s, places.n, item FROM places JOIN windows
            ON windows.n = places.n AND windows.p = w[s:s + places.n - 1]),
        hit AS (
            SELECT r, count(DISTINCT k) AS n_hit
            FROM (SELECT r, unnest(range(s, s + n)) AS k FROM found) GROUP BY r),
        listed AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
            n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)""",
    # The crc32 of a decimal is worked out bit by bit: an element below 0 is one shift.
    "op11_conversation_trie": """
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn
            FROM conversations WHERE conv_id IS NOT NULL),
        s AS (
            SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST,
                md5(concat(strlen(r), ':', r, x))) AS q FROM t GROUP BY c),
        bits AS (
            SELECT c, q, list_concat([4294967295], flatten(list_transform(string_split(c::VARCHAR, ''),
                lambda k: list_concat([ascii(k)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))) AS e FROM s),
        h AS (
            SELECT c, q, xor(list_reduce(e, lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295) % 9 AS h FROM bits),
        r AS (
            SELECT h.c, list_concat(coalesce(b.q[1:h.h], []), h.q[h.h + 1:]) AS q
            FROM h LEFT JOIN s b ON b.c = h.c - h.c % 5),
        m AS (SELECT c, q, unnest(range(0, len(q) + 1)) AS d FROM r),
        k AS (SELECT c, d, md5(q[1:d]::VARCHAR) AS k, md5(q[1:d - 1]::VARCHAR) AS up, len(q) = d AS stops,
            CASE WHEN d > 0 THEN strlen(q[d].x) ELSE 0 END AS n, q FROM m),
        n AS (
            SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(n) AS n, any_value(q) AS q,
                coalesce(string_agg(CASE WHEN stops THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
            FROM k GROUP BY d, k),
        p AS (
            SELECT n.*, parent.conv_id AS parent_conv_id
            FROM n LEFT JOIN n parent ON parent.d = n.d - 1 AND parent.k = n.up),
        kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
        above AS (SELECT d, k, n, n_convs, q, unnest(range(0, d + 1)) AS j FROM n),
        below AS (
            SELECT a.j AS d, md5(a.q[1:a.j]::VARCHAR) AS k, sum((a.n_convs - 1) * a.n) AS saved,
                count(*) FILTER (WHERE kids.k IS NULL) AS leaves
            FROM above a LEFT JOIN kids ON kids.d = a.d AND kids.k = a.k GROUP BY ALL)
        SELECT p.conv_id, p.d AS depth, p.parent_conv_id, p.n_convs, coalesce(n_children, 0) AS n_children,
            leaves AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
        FROM p JOIN below ON below.d = p.d AND below.k = p.k LEFT JOIN kids ON kids.d = p.d AND kids.k = p.k""",
    "op12_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic, concat(
                CASE WHEN len(w) < 200 THEN 'A' END,
                CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
            FROM w LEFT JOIN l USING (doc_id)),
        cells AS (
            SELECT part, fails, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        orders AS (
            SELECT concat(a.x, b.x, c.x, d.x, e.x) AS o FROM x a, x b, x c, x d, x e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
        named AS (SELECT o, step, substr(o, step, 1) AS x, substr(o, 1, step - 1) AS before FROM steps),
        held AS (
            SELECT *, contains(fails, x) AS hit, length(translate(fails, before, '')) < length(fails) AS gone
            FROM named, cells),
        counted AS (
            SELECT part, o AS filter_order, step::INTEGER AS step, x,
                coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (WHERE hit AND gone), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (WHERE fails = x), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS toxic_lost
            FROM held GROUP BY ALL)
        SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM counted""",
}
