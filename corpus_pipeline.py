"""A corpus pipeline of four stages: language ID, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of documents. A stage reads nothing but ``docs``: its decisions rest
on what its predecessor kept. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import bpe, jaccard, langid, mixing
from vigil.llm.components import sized
from vigil.llm.queries import table, tokenizer_path
from vigil.session import written

LEAST_SCORE = 0.3  # mean probability of the best language; far below what whole texts in a known language get


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``docs`` has (case does not count): each given name, with ``_`` in front
    until it is free. Extra columns of any name thus pass through every stage unchanged."""
    used, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: texts that are null or without letters, and those the network cannot place.

    The network learns from the labelled rows among ``docs`` itself; without any label nothing can be placed.
    """
    lang, score = fresh(docs, "_lang", "_score")
    network = langid.fit(docs.filter(~langid.held_out()))
    told = langid.predict(docs, network, keep=tuple(docs.columns), out=(lang, score))
    return told.filter((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five-word shingles, Jaccard similarity of 0.8 and more.

    One row of each group stays: that with the smallest doc_id, and with the smallest set of shingles among several texts
    of that doc_id. A row without doc_id stays only if its group has none with one. A text without shingles is in no
    group: it stays once for each doc_id. Rows whose doc_id is their own are judged by it, so their texts are shuffled
    only if very many go; only rows that share a doc_id, or have none, are told apart by their sets.
    """
    key, kept, of_set = fresh(docs, "_id", "_kept", "_set")
    found = written(jaccard.join(docs, shingle=5, percent=80, groups=True), "pipeline")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "set_id")).alias("first")
    stay = found.filter("group IS NOT NULL").groupBy("group").agg(first).select(F.col("first.doc_id").alias(key), F.col("first.set_id").alias(kept))
    stay = written(stay, "pipeline")
    ids = found.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("rows"), F.min("set_id").alias(kept))
    ids = written(ids, "pipeline")
    shared = written(ids.filter(F.expr("rows > 1") | F.col(key).isNull()).select(key), "pipeline")
    alone = (F.col("rows") == 1) & F.col(key).isNotNull() & F.col(kept).isNotNull()
    gone = written(ids.filter(alone).join(stay, [key, kept], "left_anti").select(key), "pipeline")

    of_shared = docs["doc_id"].eqNullSafe(shared[key])
    single = docs.join(sized(gone), docs["doc_id"] == gone[key], "left_anti").join(sized(shared), of_shared, "left_anti")
    several = jaccard.with_set(docs.join(sized(shared), of_shared, "left_semi"), of_set, shingle=5)
    best = several.join(sized(stay), several["doc_id"].eqNullSafe(stay[key]) & (several[of_set] == stay[kept]), "left_semi")
    best = best.dropDuplicates(["doc_id", of_set])
    blank = several.filter(F.col(of_set).isNull()).dropDuplicates(["doc_id", "text"])
    return single.unionByName(best.unionByName(blank).drop(of_set))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources come near their target weights; a row for every copy.

    Rows that share a doc_id, or have none, all take the most copies that any of them is given.
    """
    key, copies, copy = fresh(docs, "_id", "_copies", "_copy")
    taken = mixing.mix(docs).filter("copies > 0").groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies))
    copied = docs.join(taken, docs["doc_id"].eqNullSafe(taken[key]))
    return copied.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, for every copy in the mix."""
    return bpe.digest(docs, tokenizer_path())


STAGES = [("language ID", language), ("near-duplicates", duplicates), ("mixing", mix), ("tokens", tokens)]

#: SQL cannot express the trained network, so the rows of ``run`` are tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
