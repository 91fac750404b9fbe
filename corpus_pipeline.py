"""The corpus pipeline: quality, near-duplicates, contamination, secrets, tokens.

Each stage takes the documents its predecessor kept, with their columns, and the folder of tables. `run`
writes every stage's result as Parquet into the shared folder and reads it for the next one, so a lost
executor costs at most part of a stage.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbline.llm import op2_winnowing, op3_simhash, op6_quality, op8_bpe, op9_secrets
from kerbline.plans.durable import shared_folder


#: Rows that a Python worker gets at once. Documents are long: the default of 10,000 would hold tens of MB
#: of text several times over, in workers that live through all stages.
ROWS = 1_000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Lower the session's batch size to ROWS; it stays so, as a stage runs after its function has returned."""
    now = int(spark.conf.get(BATCH, "10000"))
    if now <= 0 or now > ROWS:
        spark.conf.set(BATCH, str(ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and their language's perplexity band."""
    _small_batches(spark)
    return op6_quality.reject(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    _small_batches(spark)
    return op3_simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passages of the benchmark worth a twentieth of their words."""
    _small_batches(spark)
    return op2_winnowing.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked by their kind."""
    _small_batches(spark)
    return op9_secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the digests and the number of their tokens, which replace columns of these names."""
    _small_batches(spark)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_tokens", "ids_sha256", "decoded_sha256")]
    coded = op8_bpe.decode(op8_bpe.encode(docs.select(F.struct(*kept).alias("row"), "text")))
    return coded.select(
        "row.*",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scans", secrets),
    ("BPE", tokens),
]

#: SQL expresses neither the fingerprints nor the tokens; tests/llm compares `run` with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    home = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{home}/{k}")
        docs = spark.read.schema(made.schema).parquet(f"{home}/{k}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
