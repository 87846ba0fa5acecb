"""From raw documents to packed sequences: quality rules, near-duplicate removal, personal data, packing.

Every stage takes the table its predecessor left, and all but the last return the columns they were given. Rows of one
doc_id are one document here: the second stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradloom.llm.jaccard import SHIPPED_ROWS, link_rows, text_key
from gradloom.llm.packing import packed_documents
from gradloom.llm.pii import redact
from gradloom.llm.quality import fit_line_field, judge_quality
from gradloom.session import reliable_checkpoint, scratch_path

# Near-duplicates of this stage: width of a shingle and shared shingles in a hundred.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the line field keep."""
    field = fit_line_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge_quality(docs, field).where("kept").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates: the one with the smallest doc_id, one without a doc_id last.

    Documents link when 80 of 100 of their shingles of five words are shared. Texts without words link with nothing.
    Rows are named by doc_id and digest of the text, so a row goes only for a copy of its own. Rows of one doc_id are one
    document: where a doc_id comes first in several components, one of them keeps it (``elected``) and the others keep
    their next row; a text that no other doc_id holds a copy of then goes. Rows that go are named, not those that stay,
    so the table that is joined stays small in a clean corpus.
    """
    found = scratch_path(spark, "components")
    alone = -1 - F.shiftrightunsigned(F.xxhash64("doc_id", "text_key"), 1)
    rows = link_rows(docs, NEAR_PERCENT, NEAR_WORDS).where("comp IS NOT NULL OR doc_id IS NOT NULL")
    rows.select("doc_id", "text_key", "n_shingles", F.coalesce("comp", alone).alias("unit")).write.parquet(found)
    rows = spark.read.parquet(found)
    stay = elected(rows).select("doc_id", "text_key")
    keys = rows.groupBy("doc_id", "text_key").count()
    gone = _shipped(keys.join(stay, _same(keys, stay), "left_anti").select("doc_id", "text_key"))
    kept = docs.join(gone, _same(docs, gone, text_key(docs["text"])), "left_anti")
    again = keys.where("count > 1")
    again = reliable_checkpoint(again.join(stay, _same(again, stay), "left_semi").select("doc_id", "text_key"))
    if not again.head(1):
        return kept
    again = _shipped(again)
    single = kept.join(again, _same(kept, again, text_key(kept["text"])), "left_anti")
    several = kept.join(again, _same(kept, again, text_key(kept["text"])), "left_semi")
    one = several.groupBy("doc_id", text_key().alias("text_key")).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return single.unionByName(one.select("row.*"))


def elected(rows: DataFrame) -> DataFrame:
    """The row that stays of every unit: doc_id, text_key and unit; no doc_id twice, rows without one as often as they come.

    Each round the units that have no row yet name their first one whose doc_id is free; of several that name the same doc_id
    the one with the longest text gets it. Rounds after the first hold only the units that lost.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key", "n_shingles")).alias("first")
    found = None
    while True:
        heads = reliable_checkpoint(rows.groupBy("unit").agg(first).select("unit", "first.*"))
        named = heads.where("doc_id IS NOT NULL").groupBy("doc_id")
        best = named.agg(F.max_by("unit", F.struct("n_shingles", "text_key", "unit")).alias("unit")).select("unit")
        won = heads.where("doc_id IS NULL").select("unit").unionByName(best)
        lost = reliable_checkpoint(heads.join(won, "unit", "left_anti").select("unit"))
        new = heads.join(won, "unit").select("doc_id", "text_key", "unit")
        found = new if found is None else found.unionByName(new)
        if not lost.head(1):
            return reliable_checkpoint(found)
        rows = rows.join(lost, "unit", "left_semi").join(found.where("doc_id IS NOT NULL").select("doc_id"), "doc_id", "left_anti")
        rows = reliable_checkpoint(rows)


def _same(left: DataFrame, right: DataFrame, digest=None):
    """Whether two rows are of one doc_id, or both of none, and of one text; ``digest`` of the left one, if it is no column."""
    own = left["text_key"] if digest is None else digest
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (own == right["text_key"])


def _shipped(keys: DataFrame) -> DataFrame:
    """Broadcast if short: texts then stay where they are; a longer list meets them by a shuffle."""
    return F.broadcast(keys) if keys.limit(SHIPPED_ROWS + 1).count() <= SHIPPED_ROWS else keys


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the name of its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    return packed_documents(docs)


STAGES = [("quality rules", quality), ("near-duplicates", deduplicate), ("personal data", personal_data), ("packing", packing)]
# The line field and the packing order are no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline as a query."""
    return run(spark, sf_dir)


QUERIES = [pipeline]
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
