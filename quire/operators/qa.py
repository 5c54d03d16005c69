"""Which chunks a person looks at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.config import Settings


def review_sample(chunks: DataFrame, sections: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """id, section_id, reason: all chunks of the named kinds of sections, and a fixed share of the others by hash."""
    heads = sections.select(F.col("id").alias("section_id"), "heading_path")
    always = F.lower("heading_path").rlike("|".join(settings.qa_always))
    draw = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = chunks.join(heads, "section_id").withColumn("reason", F.when(always, "always").when(draw < settings.qa_share, "sample"))
    return rows.filter("reason IS NOT NULL").select("id", "section_id", "reason")
