"""A training corpus out of the raw documents, stage by stage.

Every stage takes the documents that its predecessor kept, whole, and gives the
documents that go on, with the same columns. The last one gives their encodings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.llm import mixing, parity, pieces, quality, secrets
from cohortwise.llm.common import Workspace, bucket, table

KEEP_SCORE = 0.3
REDACTED = "[secret]"


def _decided(spark: SparkSession, name: str, decide: Callable[[Workspace], DataFrame]) -> DataFrame:
    """A stage's decisions, a row or less for each document, stored; the working copies
    that led to them go at once."""
    work = Workspace(spark, name)
    kept = Workspace(spark, f"{name}-decided").stored(decide(work), "rows")
    work.remove()
    work.release()
    return kept


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of these ids, null among them. The ids of a corpus have no bound, so
    they are never broadcast: the join is planned alike at every size."""
    ids = ids.select(F.col("doc_id").alias("_id")).hint("merge")
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""

    def decide(work: Workspace) -> DataFrame:
        learn = bucket(F.col("doc_id"), 5) != 0
        scores = quality.quality_scores(docs, table(spark, sf_dir, "labels"), learn, work=work)
        return scores.filter(F.col("score") >= KEEP_SCORE).select("doc_id")

    return _only(docs, _decided(spark, "quality", decide))


def first_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more.
    Documents without words are groups of their own; of rows that repeat a document,
    one stays."""

    def decide(work: Workspace) -> DataFrame:
        groups = parity.jaccard_components(docs, words=5, percent=80, work=work)
        kept = groups.filter(F.col("component_id").eqNullSafe(F.col("doc_id")))
        return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))

    kept = _decided(spark, "copies", decide)
    several = kept.filter("rows > 1").select(F.col("doc_id").alias("_id"))
    repeated = docs.join(several, docs["doc_id"].eqNullSafe(several["_id"]), "left_semi")
    repeated = repeated.dropDuplicates(["doc_id", "text"])
    return _only(docs, kept.filter("rows = 1")).unionByName(repeated).select(docs.columns)


def _without(text: Column, findings: Column) -> Column:
    """The text with each run of findings replaced."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(done: Column, span: Column) -> Column:
        between = F.substr(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        added = F.concat(done["out"], between, F.lit(REDACTED))
        return F.struct(
            F.when(span["start"] < done["at"], done["out"]).otherwise(added).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"),
        )

    rest = lambda done: F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int")))
    return F.aggregate(findings, start, step, rest)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced; ``n_chars`` follows the text."""

    def decide(work: Workspace) -> DataFrame:
        found, _ = secrets.scan_versions(docs, ["doc_id"], work=work)
        hits = found.filter(F.size("findings") > 0).dropDuplicates(["doc_id", "blob"])
        return hits.select(F.col("doc_id").alias("_id"), "blob", "findings")

    hits = _decided(spark, "secrets", decide)
    same = docs["doc_id"].eqNullSafe(hits["_id"]) & (F.unhex(F.sha2(docs["text"], 256)) == hits["blob"])
    clean = F.when(F.col("findings").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("findings")))
    out = docs.join(hits, same, "left").withColumn("text", clean)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("findings").isNull(), F.col("n_chars")).otherwise(length))
    return out.select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the raked rates of source, language and topic, each once: rates
    are raked to be 1 at most."""

    def decide(work: Workspace) -> DataFrame:
        return mixing.mix_to_targets(docs, power=0.8, share=0.9, once=True, work=work).select("doc_id")

    return _only(docs, _decided(spark, "mixing", decide))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The four best segmentations of each document: the ids of the best, and what the
    others cut otherwise."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", first_of_copies),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

# Learned scores and rakings are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; a stage's documents
    go once those of the next are written."""
    work = Workspace(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        docs, path = work.keep(stage(spark, docs, sf_dir), f"stage-{number}")
        if before is not None:
            work.drop(before)
        before = path
        work.release()
    return docs
