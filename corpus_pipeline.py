"""A corpus from raw documents to token digests, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the stages
before the last return the columns of ``documents`` for the rows they keep.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import bpe, mixing, simhash, suffix_dedup, toxicity
from citeloom.llm.queries import RANKS, table
from citeloom.sources.staged import new_stage_path, write_stage


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage uses, and the rest in one column, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*(rest or [F.lit(0).alias("none")])).alias("others"))


def _unpacked(df: DataFrame, columns: list[str], *used: str) -> DataFrame:
    return df.select(*(c if c in used else F.col("others").getField(c).alias(c) for c in columns))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar predicts to be toxic go.

    The model is learned from the labels of the documents given. Texts are
    judged whole, however long; a null or empty one has no clause that matches
    and is judged by that. Repeated rows and rows without an id are judged one
    by one, equal texts alike. No labels, or labels of one kind, leave the
    grammar with its starting words; an empty table gives no rows. All columns
    pass, whatever their names.
    """
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_packed(docs, "doc_id", "text"), model)
    return _unpacked(scored.where("predicted = 0"), docs.columns, "doc_id", "text")


def _text_hash(text: Column) -> Column:
    """A null text is not the empty one."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component one row stays: of smallest id, then of smallest text hash.

    A row that repeats id and text stays once; rows without an id stay, as
    nothing tells which of them stands for which. Null, empty and wordless
    texts share the fingerprint zero, so one of them stays, a null text before
    others of its id. Texts are read whole, however long; an empty table gives
    no rows. All columns pass, whatever their names.
    """
    hashed = docs.select("doc_id", "text", _text_hash(F.col("text")).alias("text_hash"))
    rows = simhash.row_components(hashed, columns=("text_hash",)).where("id IS NOT NULL")
    chosen = (
        rows.groupBy("component")
        .agg(F.min(F.struct("id", "text_hash")).alias("least"))
        .select(F.col("least.id").alias("chosen"), F.col("least.text_hash").alias("chosen_hash"))
    )
    known = docs.where("doc_id IS NOT NULL")
    same = (known["doc_id"] == chosen["chosen"]) & (_text_hash(known["text"]) == chosen["chosen_hash"])
    kept = known.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).union(docs.where("doc_id IS NULL"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that an earlier document holds go; characters cut in two go whole.

    Every row stays, a text that was all repeats as the empty one; a null text
    becomes empty too. Rows of one id are one document and are cut alike; rows
    without an id come after all others. Texts are compared whole, however
    long; an empty table gives no rows. ``n_chars`` is counted anew, the other
    columns pass, whatever their names.
    """
    cut = suffix_dedup.remove_repeats(_packed(docs, "doc_id", "text", "n_chars"), columns=("others",))
    whole = cut.withColumn("text", F.col("kept").cast("string"))
    counted = whole.withColumn("n_chars", F.char_length("text").cast("long"))
    return _unpacked(counted, docs.columns, "doc_id", "text", "n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row per reading, the last of a source cut where its target is reached.

    Texts without words (null, empty, white space) are never read and have no
    row. Documents of one source come in the order of their id's hash, then id
    (null first), then size, and repeated rows are documents of their own. A
    null source is a source of its own. Very long texts are read and cut like
    any other; an empty table gives no rows. ``n_chars`` is counted anew, the
    other columns pass, whatever their names.
    """
    used = ("doc_id", "source", "text", "n_chars")
    plan = mixing.plan_mix(_packed(docs, *used), keep=("text", "others"))
    read = mixing.training_order(plan, "text")
    return _unpacked(read.withColumn("n_chars", F.char_length("text").cast("long")), docs.columns, *used)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every text that is read.

    A null text counts as empty, which has no tokens; texts are encoded whole,
    however long; repeated rows and null ids give rows of their own; an empty
    table gives no rows. Only the id is kept of the other columns.
    """
    return bpe.round_trip(docs, bpe.load_codec(RANKS, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash near-dedup", keep_one_of_near_duplicates),
    ("suffix-array dedup", remove_repeated_passages),
    ("mixing", mix_sources),
    ("byte-level BPE", tokenize),
]

#: The learned model, XXH64 and the merges have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), new_stage_path(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)
