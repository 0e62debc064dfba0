"""Five stages from raw documents to token ids: toxic texts out, repeated passages out, near copies out, benchmark leaks out, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.bytebpe import encode_documents
from meterflow.llm.decontaminate import without_contaminated
from meterflow.llm.minhash import near_duplicates
from meterflow.llm.shared import stored
from meterflow.llm.toxicity import fit, without_toxic
from meterflow.llm.winnow import without_repeated_lines

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model takes for toxic go. Missing and empty texts are judged by the bias alone and stay."""
    return without_toxic(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are cut out. A document of which only white space is left goes; one that had none (missing or empty) stays.

    n_chars is counted anew where lines are cut out.
    """
    # (the other columns travel as one, so that none has the name of a result)
    cut = without_repeated_lines(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")), tails=True)
    cut = cut.where("NOT (size(removed) > 0 AND text RLIKE '^[ \\t\\n]*$')")
    made = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[made.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest doc_id stays. Empty texts and rows without doc_id are in no group; rows that share a doc_id share its fate."""
    gone = near_duplicates(docs, SHINGLE_WORDS, SIMILARITY_PERCENT).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark, verbatim or edited, go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document that is left, with digests of the ids and of the decoded bytes."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs


ORACLE_SQL = None
