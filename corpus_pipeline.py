"""From documents to shards of a training mix, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tickloom.llm import decontam, jaccard, langid, mixing, sharding
from tickloom.session import staged
from tickloom.sources.shared_tables import table

MIN_SCORE = 0.4
WORD = r"[^\x20\x09-\x0D]"

# Models, running sums over hashes and minimax cuts are not SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear: one language has at least two fifths of the
    pooled probability of their letters. The model learns from a bounded sample of the documents
    whose language is known. Null, empty and letterless texts go."""
    model = langid.fitted(docs, F.lit(True))
    found = langid.identified_rows(docs, model)
    clear = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE)
    return found.filter(clear).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked documents: that with the smallest id, a
    null id last, and of several texts of an id that with the smallest hash. Of rows
    alike in id and text one stays. Texts without words are linked with nothing, so
    all of them stay."""
    found = jaccard.rooted(docs.select("doc_id", "text"), jaccard.PERCENT, "text", "doc_id", ["doc_id"])
    rows = staged(found.filter("n > 0").select("root", "id", "print"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "print")).alias("first"))
    copies = rows.groupBy("id", "print").agg(F.count(F.lit(1)).alias("_copies"))
    own = first.select("first.id", "first.print").alias("f").join(
        copies.alias("c"), F.expr("f.id <=> c.id AND f.print = c.print")
    )
    kept = staged(own.select(F.col("f.id").alias("_id"), F.col("f.print").alias("_print"), "_copies"))
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64("text") == kept["_print"])
    single = docs.filter(worded).join(kept.filter("_copies = 1"), same).select(*docs.columns)
    left = single.unionByName(docs.filter(~worded))
    several = kept.filter("_copies > 1")
    if several.isEmpty():
        return left
    # Copies of a row merge in the tasks that read them, before any is shuffled.
    others = [F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns]
    merged = docs.filter(worded).join(several, same).groupBy("_id", "_print").agg(*others)
    return left.unionByName(merged.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in a benchmark passage."""
    return decontam.without_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes its words, rounded: not at all up to
    three times. Rows alike in id and text share what the mix takes of them."""
    marked = docs.select("doc_id", "text", "source", F.xxhash64("text").alias("_print"))
    pieces, lined = mixing.mix(marked, keep=["doc_id", "_print"])
    taken = mixing.taken(pieces, lined).filter("size > 0")
    rows = taken.select(F.col("row.doc_id").alias("_id"), "row._print", "taken", "size")
    times = F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_times")
    wanted = staged(rows.groupBy("_id", "_print").agg(times).filter("_times > 0"))
    own = docs["doc_id"].eqNullSafe(wanted["_id"]) & (F.xxhash64("text") == wanted["_print"])
    return docs.join(wanted, own).withColumn("_turn", F.explode(F.sequence(F.lit(1), "_times"))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row that is left, copies of a text together."""
    return sharding.shard(docs, keep=["doc_id", "lang", "source"])


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written down before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
