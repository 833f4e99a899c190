"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavetrawl.operators.ordering import materialise

__all__ = ["ID", "TEXT", "compact", "discard", "fold", "id_and_text", "materialise", "read_table", "text_key"]

# Rows of a small table that one task may write.
ROWS_PER_TASK = 200_000

ID, TEXT = "__id", "__text"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The top-level column of that very name, whatever dots or marks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), under names that no other column can clash with."""
    return docs.select(quoted(id_col).alias(ID), F.coalesce(quoted(text_col), F.lit("")).alias(TEXT))


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many marks before it as no column of the frame has."""
    taken, result = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        result.append(name)
    return result


def compact(rows: DataFrame, at_most: int) -> DataFrame:
    """Fewer tasks for a table known to have ``at_most`` so many rows; it never has more rows per task than
    ``ROWS_PER_TASK`` by that, nor more tasks than before."""
    return rows.coalesce(at_most // ROWS_PER_TASK + 1)


def discard(*tables: DataFrame) -> None:
    """Delete tables given by ``materialise`` that no later step reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fold(id_column: Column, folds: int) -> Column:
    """The id's fold: crc32 of its decimal digits, modulo ``folds`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def text_key(text: Column) -> Column:
    """Tells rows apart that share an id; rows equal in both count as one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
