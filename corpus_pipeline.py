"""From raw documents to token ids: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``documents``. Where rows must be told apart they are numbered and written first, so repeated
rows and ids are fine; a null id or text is kept as far as a stage's rule allows.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetide.llm import bpe, decontaminate, pii, quality, simhash
from coursetide.llm.inputs import cut_lineage, findable, in_fold, read
from coursetide.llm.queries import PII_KEY, RANKS

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Models and hashes have no SQL counterpart; tests hold the stages against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.5; learned from the labels of this table."""
    labels = read(spark, sf_dir, "labels").where(~in_fold("doc_id", 3, 1))
    ranking = quality.learn(read(spark, sf_dir, "documents"), labels)
    scored = quality.score(docs.select(*COLUMNS), ranking, out="quality_score")
    return scored.where(F.col("quality_score") >= 0.5).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id, null ids last.

    Groups are those of ``simhash``: fingerprints over runs of three words, linked at two or fewer
    differing bits. Rows are written with a number of their own first, which holds however often a
    scan is planned or a task runs again.
    """
    rows = cut_lineage(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    prints = cut_lineage(simhash.fingerprints(rows.select("text", place.alias("place")), doc_id="place"))
    grouped = simhash.near_duplicates(prints)
    kept = grouped.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found, and that are not most of one."""
    found = decontaminate.contaminated(docs, read(spark, sf_dir, "benchmark"), short=True)
    return decontaminate.without(docs.select(*COLUMNS), cut_lineage(found))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and ``n_chars`` counted anew."""
    rewritten = pii.pseudonymise(docs.select(*COLUMNS), PII_KEY)
    return rewritten.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and whether decoding them gives back the text's bytes."""
    findable(spark)
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs, path, pattern), path)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("pii", pseudonyms),
    ("bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
