"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm import centroids, decontam, jaccard, langid, mixing, phrases, pii, quality, sharding, substrings, tokens, topk, toxicity
from tickloom.session import shared_folder
from tickloom.sources.shared_tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def fold(parts: int) -> Column:
    """Which part of the rows, by the checksum of the id as text, a row is in."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


@query
def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    pieces, lined = mixing.mix(table(spark, sf, "documents"), keep=["doc_id"])
    return mixing.taken(pieces, lined).select("row.doc_id", "size", "source_size", "target", "taken")


@query
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality.fit(docs, table(spark, sf, "labels"), fold(4) != 2, "quality")
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted")


@query
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.fitted(docs.select("doc_id", "text", "lang"), fold(4) != 2)
    found = langid.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op4_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op5_sharding(spark: SparkSession, sf: str) -> DataFrame:
    shards = sharding.shard(table(spark, sf, "documents"), keep=["doc_id"])
    return shards.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.cluster(table(spark, sf, "documents"), keep=["doc_id"])


@query
def op7_tokens(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    tokens.write(table(spark, sf, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read(spark, folder)


@query
def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(table(spark, sf, "documents"), keep=["doc_id"])
    plain = F.filter("pii", lambda s: s["plain"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("long").alias(f"n_{kind}")  # noqa: B023
        for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(plain), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
    )


@query
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    marked = decontam.mark(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"), fold(5) != 0, "toxic")
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@query
def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(table(spark, sf, "embeddings"), keep=["vec_id"])


@query
def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine(table(spark, sf, "documents"))


@query
def op13_substrings(spark: SparkSession, sf: str) -> DataFrame:
    left = substrings.remove(table(spark, sf, "documents"), keep=["doc_id"])
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES: dict[str, str] = {}

ORACLES["op4_topk"] = """
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op9_decontamination"] = r"""
WITH lowered AS (
    SELECT doc_id AS id, true AS is_doc,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
    UNION ALL
    SELECT item_id, false, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
), worded AS (
    SELECT id, is_doc, regexp_extract_all(coalesce(body, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), items AS (
    SELECT id AS item_id, w, least(13, len(w)) AS n FROM worded WHERE NOT is_doc AND len(w) > 0
), needles AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)
), docs AS (
    SELECT id AS doc_id, w FROM worded WHERE is_doc
), windows AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM needles))
), hits AS (
    SELECT doc_id, n, i, item_id FROM windows JOIN needles USING (n, gram)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ORACLES["op6_jaccard"] = r"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), commons AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM commons JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

# Each round: nearest centroid by squared distance, then means rounded down.
_NEAREST = """near{n} AS (
    SELECT vec_id, arg_min(cluster, (gap, cluster)) AS cluster, min(gap) AS distance FROM (
        SELECT vec_id, cluster, sum((x - c) * (x - c)) AS gap FROM parts JOIN centre{n} USING (dim) GROUP BY ALL
    ) GROUP BY vec_id
)"""
_MOVED = """sums{n} AS (
    SELECT cluster, dim, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM parts JOIN near{n} USING (vec_id) GROUP BY ALL
), centre{m} AS (
    SELECT cluster, dim, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
    FROM centre{n} LEFT JOIN sums{n} USING (cluster, dim)
)"""
ORACLES["op11_centroids"] = f"""
WITH whole AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = {centroids.DIMS} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, unnest(range(1, {centroids.DIMS} + 1)) AS dim, unnest(v) AS x FROM whole
), chosen AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id)) - 1 AS cluster FROM whole
), centre0 AS (
    SELECT cluster, dim, CAST(x AS HUGEINT) AS c FROM parts JOIN chosen USING (vec_id) WHERE cluster < {centroids.CLUSTERS}
), {", ".join(_NEAREST.format(n=n) + ", " + _MOVED.format(n=n, m=n + 1) for n in range(centroids.ROUNDS))},
{_NEAREST.format(n=centroids.ROUNDS)}, digests AS (
    SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY dim)) AS centroid_sha256
    FROM centre{centroids.ROUNDS} GROUP BY cluster
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near{centroids.ROUNDS} JOIN digests USING (cluster)
"""

ORACLES["op13_substrings"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(w[i : i + 19], ' ')) AS gram
    FROM (SELECT *, unnest(range(1, len(w) - 18)) AS i FROM docs)
), later AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS places FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs) ANTI JOIN
         (SELECT doc_id, unnest(places) AS p FROM gone) USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op12_phrases"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counts AS MATERIALIZED (
    SELECT lang, size, w[i : i + size - 1] AS g, count(*) AS f
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM worded, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
    GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, g, f AS a FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
    SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r,
           (1000000 * CAST(c.a AS HUGEINT) * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts x ON x.lang = c.lang AND x.g = c.g[1 : k]
    JOIN counts y ON y.lang = c.lang AND y.g = c.g[k + 1 :]
), worst AS (
    SELECT lang, g, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score FROM cuts GROUP BY ALL
), around AS (
    SELECT lang, g, max(a) AS a
    FROM (SELECT lang, g[p : p + 1] AS g, a FROM (SELECT *, unnest([1, 2]) AS p FROM candidates WHERE size = 3)) GROUP BY ALL
), ranked AS (
    SELECT w.lang, array_to_string(w.g, ' ') AS phrase, w.a, w.l, w.r, n, CAST(score AS BIGINT) AS score
    FROM worst w JOIN totals USING (lang) LEFT JOIN around o ON o.lang = w.lang AND o.g = w.g
    WHERE coalesce(100 * o.a < 50 * w.a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= 2000
"""
