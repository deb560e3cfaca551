"""A pipeline over ``documents``: each stage's result is written as Parquet and reread as the next one's input.

All stages but the last return the columns of ``documents``. A stage works on every row its predecessor kept.

Null texts count as empty in every decision and stay null. Ids may be null or repeat. Extra columns travel in one column
beside the text, so that their names clash with none. An empty table passes all stages as one. Of equal texts the row
with the largest id goes on, of near copies that with the smallest; of rows with equal ids and texts it is open which.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, source_mix, toxicity
from touchline.llm.common import drop_staged, small_batches, staged, table
from touchline.llm.exact_dedup import exact_duplicates
from touchline.llm.queries import PATTERN, RANKS
from touchline.llm.simhash import near_duplicates


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text, and all other columns in one, ``_doc``, so that no name clashes with an operator's."""
    others = [F.col(name) for name in docs.columns if name != "text"]
    # In place of the text, whether it is null: operators may take null for empty.
    return docs.select("doc_id", "text", F.struct(F.isnull("text").alias("text"), *others).alias("_doc"))


def _unpacked(packed: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` again."""
    kept = F.when(~F.col("_doc.text"), F.col(text)).alias("text")
    return packed.select(*[kept if name == "text" else F.col("_doc")[name].alias(name) for name in docs.columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not predict to be toxic. Labels held out for testing teach nothing."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~F.coalesce(toxicity.held_out(), F.lit(True))))
    return _unpacked(toxicity.score(_packed(docs), model, keep=["_doc", "text"]).where("score < 0.5"), docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id."""
    return _unpacked(exact_duplicates(_packed(docs), carry=["_doc"]).where("kept"), docs, "_text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links connect: that with the smallest id."""
    return _unpacked(near_duplicates(_packed(docs), keep=["_doc", "text"]).where("kept"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture to the target weights, each document as often as its epochs say."""
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row"))
    numbered = staged(rows, "numbered")
    leaves = numbered.select("_row", "_doc.doc_id", "_doc.text", "_doc.lang", "_doc.source")
    mixed = source_mix.mix(source_mix.with_domain(leaves), source_mix.LEVELS, keep=["_row"])
    chosen = mixed.where("copies > 0").select("_row", "copies")
    repeated = numbered.join(chosen, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return repeated.select("_doc.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row of the mixture, and what they decode to, as digests."""
    small_batches(spark)
    return bpe.token_digests(docs, RANKS, PATTERN)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        result = staged(stage(spark, docs, sf_dir), "stage")
        if number:
            drop_staged(docs)
        docs = result
    return docs


#: A trained model decides in the first stage, which SQL cannot express; tests hold it against a brute-force version.
ORACLE_SQL = None
