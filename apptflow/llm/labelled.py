"""A bounded sample of labelled documents for the models that are fitted here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptflow.llm.language import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: str, per_grade: int) -> tuple[list[str], list[int]]:
    """Texts and grades of at most ``per_grade`` labelled rows of each grade.

    Held-out rows take no part. Rows are chosen by a hash of the id, so the sample does
    not follow the table's order. An id that is labelled twice counts with its largest
    grade. The number of grades is taken to be small (they are ratings).
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(grade).cast("int").alias("grade"))
    known = known.where("doc_id is not null and grade is not null").where(~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    grades = [r.grade for r in known.select("grade").distinct().orderBy("grade").collect()]
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(grade))
    texts: list[str] = []
    found: list[int] = []
    for g in grades:
        few = known.where(F.col("grade") == g).orderBy(order, "doc_id").limit(per_grade).select("doc_id")
        # per_grade ids at most
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        rows = own.where("text is not null").join(F.broadcast(few), "doc_id")
        rows = rows.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
        got = rows.select("text").toArrow().column("text").to_pylist()
        texts += got
        found += [g] * len(got)
    return texts, found
