"""The corpus pipeline: documents in, token ids of the kept ones out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearmask.llm import bpe, decontaminate, language, quality, simhash
from yearmask.llm.common import crc_mod, materialize, spread, table
from yearmask.llm.queries import codec

#: a language is rejected when all others together are likelier, by calibrated probabilities, and texts of known languages
#: are hardly ever so uncertain
LEAST_SCORE = 0.5


def apart(docs: DataFrame) -> DataFrame:
    """docs under names that no stage gives to columns of its own."""
    return docs.select([F.col(c).alias(f"d_{c}") for c in docs.columns])


def as_before(marked: DataFrame, docs: DataFrame) -> DataFrame:
    return marked.select([F.col(f"d_{c}").alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known: they have letters, and one language is likelier than all others together.

    Null, empty and letterless texts go. Repeated rows are judged alike and stay or go together; whole texts count,
    however long. An empty table, or one without any label to learn from, keeps nothing.
    """
    docs = spread(docs)
    model = language.train(docs.where(crc_mod("doc_id", 3) != 1).select("text", "lang"))
    if not model.languages:
        return docs.where(F.lit(False))
    known = language.with_language(apart(docs), model, text="d_text", name="lang", score="score")
    return as_before(known.where((F.col("lang") != "und") & (F.col("score") >= min(LEAST_SCORE, model.usual))), docs)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are predicted to be of good quality (score >= 0.3).

    Null and empty texts have statistics of 0 and are scored like any other; rows with null ids are scored, never learned
    from. Repeated rows stay or go together. Without labels of both kinds all documents have the same score.
    """
    known = quality.labelled(docs.select("doc_id", "text").where(crc_mod("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    model = quality.train_on(quality.with_statistics(known).drop("text"))
    scored = quality.with_quality(quality.with_statistics(apart(docs), text="d_text"), model, threshold=0.3)
    return as_before(scored.where("predicted = 1"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one of the smallest doc_id.

    Texts without words all have fingerprint 0 and are one group. A null id counts as the largest, so such a row stays only
    if its group has no other. Of rows with the same id and fingerprint the one whose columns have the smallest hash stays;
    of equal rows any, which gives the same table.
    """
    own = apart(docs)
    order = F.xxhash64(F.to_json(F.struct(*own.columns)))
    printed = simhash.with_fingerprint(own, text="d_text").withColumns({"id": F.coalesce(F.col("d_doc_id").cast("string"), F.lit("")), "order": order, "row": F.monotonically_increasing_id()})
    printed, _ = materialize(printed, "printed")
    grouped = simhash.near_duplicates(printed.select(F.col("d_doc_id").alias("doc_id"), "fingerprint"), radius=4)
    first = grouped.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")).alias("x"))
    keep = first.select(F.coalesce(F.col("x.doc_id").cast("string"), F.lit("")).alias("id"), F.col("x.fingerprint").alias("fingerprint"))
    rows = printed.select("id", "fingerprint", "order", "row").join(keep, ["id", "fingerprint"], "left_semi").groupBy("id", "fingerprint").agg(F.min(F.struct("order", "row")).alias("x")).select("x.row")
    return as_before(printed.join(rows, "row", "left_semi"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents without any window of a benchmark item. Null, empty and wordless texts have no windows and stay;
    repeated rows stay or go together. An empty benchmark keeps everything."""
    marked = decontaminate.contaminated(apart(docs), table(spark, sf_dir, "benchmark"), text="d_text")
    return as_before(marked.where("n_hit = 0"), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the digests of the ids and of what they decode to, a row for each document. A null
    text is an empty one."""
    return bpe.token_digests(docs, codec(), keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", encoding),
]

#: the stages learn models and tokenise, which SQL can't express; tests hold run() against a brute-force version
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
