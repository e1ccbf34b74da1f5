"""A training corpus from the documents table, in five stages, each on what the one before kept.

Toxic documents go; of near duplicates one stays; passages that an earlier document holds are cut;
documents that hold a benchmark item go; the rest is mixed by source and put in training order.

A stage frees its scratch files but those that its result reads; these go when the next stage begins
on other files.  So write a stage's result before the next one is called.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.llm.decontaminate import remove_contaminated
from rideflow.llm.mixing import mix_sources
from rideflow.llm.order_minhash import near_duplicates
from rideflow.llm.queries import toxicity_models
from rideflow.llm.suffix_dedup import remove_repeats
from rideflow.llm.toxicity import score, with_mark
from rideflow.session import scratch_made
from rideflow.sources import free_scratch, materialize, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Scratch that the latest stage's input and result read.
_held: list[str] = []


def _tidy(stage: Stage) -> Stage:
    """The stage, with scratch freed as soon as it is of no more use."""

    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _held[:] = free_scratch(spark, _held, docs)
        with scratch_made() as made:
            result = stage(spark, docs, sf_dir)
        _held.extend(free_scratch(spark, made, result))
        return result

    return tidied


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and everything else in one struct, out of the way of the operators' own columns."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.col("text").isNull().alias("no text"), *rest).alias("rest"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the packed form."""
    return packed.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns])


@_tidy
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.7 or more go."""
    scored = score(_packed(docs), toxicity_models(spark, docs, sf_dir))
    return _unpacked(scored.filter(F.col("score") < 0.7), docs)


@_tidy
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id of each class stays.  Rows that share an id are documents of their
    own: unlike texts all stay, of like ones one does.  Documents without words are in no class and stay."""
    keyed = _packed(docs).withColumn("key", F.col("doc_id"))
    twice = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    twice = materialize(twice, label="pipeline-repeated")
    if not twice.isEmpty():
        # Keys beyond all ids, so that in a class a document of an id of its own comes first.
        beyond = docs.agg(F.max("doc_id").alias("most")).first().most + 1
        again = keyed.join(twice, "doc_id", "left_semi").withColumn("key", F.lit(beyond) + F.monotonically_increasing_id())
        keyed = keyed.join(twice, "doc_id", "left_anti").unionByName(materialize(again, label="pipeline-again"))
    classes = materialize(near_duplicates(keyed.select(F.col("key").alias("doc_id"), "text")), label="pipeline-classes")
    gone = materialize(classes.filter("doc_id <> class_id").select(F.col("doc_id").alias("key")).distinct(), label="pipeline-gone")
    # Most texts have no mark and stay where they are; the few others are moved for the exact join.
    marked = with_mark(keyed, gone, "key")
    kept = marked.filter("mark").drop("mark").join(gone, "key", "left_anti").select(*keyed.columns)
    return _unpacked(marked.filter("NOT mark").select(*keyed.columns).unionByName(kept), docs)


@_tidy
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document holds are cut; n_chars follows."""
    cleaned = remove_repeats(_packed(docs), whole_characters=True)
    text = F.when(~F.col("rest")["no text"], F.decode("kept", "UTF-8"))
    cut = _unpacked(cleaned.withColumn("text", text), docs)
    if "n_chars" in docs.columns:
        kept = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
        cut = cut.withColumn("n_chars", kept)
    return cut


@_tidy
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _unpacked(remove_contaminated(_packed(docs), table(spark, sf_dir, "benchmark")), docs)


@_tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it, in the order of its training position."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Fitted models and sketches have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each result written and read again."""
    docs, kept = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scratch_made() as made:
            docs = materialize(stage(spark, docs, sf_dir), label=name)
        kept = free_scratch(spark, kept + made, docs)
    return docs
