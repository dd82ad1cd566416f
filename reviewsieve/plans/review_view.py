"""Reviews derived from the `documents` table.

The expressions are plain SQL, so that any engine can make the same view. Every
part of the duplicate key depends on the text alone, hence exact copies of a
document stay duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewsieve.session import spread

REVIEW_VIEW = {
    "ingest_seq": "doc_id",
    "rating": """CASE length(text) % 13 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3'
        WHEN 3 THEN '4' WHEN 4 THEN '5' WHEN 5 THEN '5.0' WHEN 6 THEN ' 4 ' WHEN 7 THEN '7'
        WHEN 8 THEN '2.5' WHEN 9 THEN 'true' WHEN 10 THEN NULL ELSE '5' END""",
    "title": "substr(text, 1, 30)",
    "text": """CASE WHEN length(text) % 97 = 0 THEN NULL WHEN length(text) % 89 = 0 THEN '   '
        WHEN length(text) % 83 = 0 THEN 'ok'
        WHEN length(text) % 10 = 3 THEN replace(text, '. ', '.<br /><br />')
        WHEN length(text) % 10 = 7 THEN concat('<p>', replace(text, ', ', ' &amp; '), '</p>')
        ELSE text END""",
    "asin": "concat('B', lpad(CAST(length(text) % 50 AS STRING), 4, '0'))",
    "parent_asin": "concat('B', lpad(CAST(length(text) % 10 AS STRING), 4, '0'))",
    "user_id": "concat('U', CAST(length(text) % 23 AS STRING))",
    "timestamp": "1577836800000 + doc_id * 60000",
    "helpful_vote": "doc_id % 5",
    "verified_purchase": "doc_id % 3 <> 0",
}


def reviews(spark: SparkSession, sf_dir: str, heavy: bool = True) -> DataFrame:
    """The view; `heavy` work on it is spread over all cores even if the file is small."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if heavy:
        documents = spread(documents, "doc_id")
    return documents.selectExpr(*[f"{sql} AS {name}" for name, sql in REVIEW_VIEW.items()])
