"""A corpus pipeline of five stages: language, near duplicates, benchmark passages, personal data, mix.

STAGES lists (name, function of (spark, docs, sf_dir)); every stage works on all that
the one before kept, and all but the last return the columns of documents.  run()
applies them to documents, each written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metapep.llm import language, surrogates
from metapep.llm.common import cut, join_checked, stored, table
from metapep.llm.decontamination import decontaminate
from metapep.llm.jaccard_join import SENT_IDS, jaccard_join
from metapep.llm.mixing import mix
from metapep.storage import remove, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose language scores less is in none of the learned ones.
MIN_SCORE = 0.4
#: From this score on the predicted language replaces another label.
SURE = 0.75


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the texts that are in none of the languages that the labels teach; lang becomes the language of the text.

    Null texts and those without a letter go, and texts whose best language scores less
    than MIN_SCORE.  lang is the predicted language where it is null or the score is
    SURE.  If no label teaches a language, texts with a letter stay as they are.
    Repeated rows each have their decision, the same one; an empty table stays empty;
    only the columns of documents are read, so other names can't clash.
    """
    docs = docs.select(*COLUMNS)
    model = language.train(language.labelled(docs))
    if not model.families:
        return docs.filter(docs["text"].rlike(r"\p{L}"))
    found = language.identify(docs, model, keep=COLUMNS).filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return found.withColumn("lang", F.when(F.col("lang").isNull() | (F.col("score") >= SURE), F.col("lang_pred")).otherwise(F.col("lang"))).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the least id.

    Rows without id stay, and so do null and empty texts, which are nobody's duplicates.
    Rows that repeat an id are one document: each of its different texts stays or goes
    with it, the same text once, with the least of the other columns.  An empty table
    stays empty; other names can't clash.
    """
    docs = docs.select(*COLUMNS)
    found = stored(jaccard_join(docs).filter("doc_id is not null"), "groups")
    others = cut(found.filter("doc_id <> component_id").select("doc_id").distinct())
    kept = join_checked(docs, others, "doc_id", "left_anti", SENT_IDS)
    again = cut(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"))
    if again.isEmpty():
        return kept
    twice = join_checked(kept, again, "doc_id", "left_semi", SENT_IDS).withColumn("t", F.sha2("text", 256))
    least = twice.groupBy("doc_id", "t").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("r")).select("doc_id", "r.*")
    return join_checked(kept, again, "doc_id", "left_anti", SENT_IDS).unionByName(least.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of the benchmark.

    Null and empty texts hold none and stay; so do all if the benchmark is empty.
    Repeated rows each have their decision; other names can't clash.
    """
    docs = docs.select(*COLUMNS)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=COLUMNS).filter("n_hit = 0").select(*COLUMNS)


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With surrogates for personal data; n_chars follows the text where it changed.

    No row goes: null and empty texts and those without entities stay as they are, and
    repeated rows stay alike.  The key is the session's, or the shared folder's.
    """
    own = surrogates.pseudonymise(docs.select(*COLUMNS), surrogates.secret_key(spark), keep=("doc_id", "lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return own.withColumn("n_chars", n_chars).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words taken and their source's figures.

    Texts without words take none and go.  Ties in the key are taken together; a null
    source is a source; an empty table stays empty.
    """
    return mix(docs.select(*COLUMNS), keep=COLUMNS).filter("taken > 0")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", pseudonymous),
    ("mixing", mixed),
]

#: Language models and surrogates are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has stored on its way is removed when its result is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
        if before:
            remove(spark, before)
        before = docs.inputFiles()[0].rsplit("/", 1)[0] if docs.inputFiles() else None
    return STAGES[-1][1](spark, docs, sf_dir)
