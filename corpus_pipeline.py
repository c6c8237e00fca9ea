"""From raw documents to packed training sequences.

Each stage takes all that the one before kept and returns the columns of documents,
the last one the packed pieces. ``run`` stores every stage's rows before the next
reads them, so a lost executor never costs more than one stage. A stage begins by
deleting the working tables of the stages before it in the same thread, whose rows
have been written by then; tables that its own input still reads are kept.

In every stage a null text is an empty one, a text counts as a whole however long, ids
may be null or repeated, other columns pass through whatever their names, and an empty
table gives an empty one; what a stage does in these cases is in its docstring.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm import exact_dedup, jaccard, mixing, packing, quality
from brisalake.llm.common import Stage, remove_folder, table
from brisalake.llm.queries import ranks_file

ORACLE_SQL = None
_before = threading.local()


def tidy(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``step``, after the working tables of earlier steps are gone."""
    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tail = lambda path: path.split(":", 1)[-1].lstrip("/")  # noqa: E731  without scheme
        read = [tail(f) for f in docs.inputFiles()]
        left = []
        for folder in getattr(_before, "folders", []):
            if any(f.startswith(tail(folder) + "/") for f in read):
                left.append(folder)
            else:
                remove_folder(spark, folder)
        known = set(Stage.folders())
        out = step(spark, docs, sf_dir)
        _before.folders = left + [f for f in Stage.folders() if f not in known]
        return out
    return run_step


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


@tidy
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3.

    Empty texts have a score too; equal texts have the same, so repeated rows stay or go
    together. Without labelled rows every document scores alike.
    """
    trees = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score(F.col("text"), trees) >= 0.3)


@tidy
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id.

    Null ids are below all others; of rows that agree in the id one stays. Null and
    empty texts are equal to one another.
    """
    place = free_name(docs, "_corpus_at")
    stage = Stage(spark)
    landed = stage.store(docs, "landed")
    rows = exact_dedup.exact_dedup(spark, stage.path("landed"))
    dropped = rows.filter("NOT kept").select(F.col("at").alias(place))
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return landed.withColumn(place, at).join(dropped, place, "left_anti").drop(place)


@tidy
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word shingles, the one with the smallest id.

    Null ids come after all others; of rows that agree in the id one stays. A text
    without words is linked with nothing and stays.
    """
    row = free_name(docs, "_corpus_row")
    stage = Stage(spark)
    landed = stage.store(docs.withColumn(row, F.monotonically_increasing_id()), "landed")
    linked = jaccard.jaccard_components(spark, landed, id_column=row).select(F.col("id").alias(row), "component_id")
    first = linked.join(landed.select(row, F.col("doc_id").alias("_id")), row).groupBy("component_id").agg(
        F.min(F.struct(F.col("_id").isNull(), "_id", row)).alias("first"))
    return landed.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").drop(row)


@tidy
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per draw; the document at the end of a source's target is cut to the word.

    A null source is a source. Texts without words have nothing to draw and do not
    appear; ``n_chars`` follows the drawn text.
    """
    documents, drawn = mixing.mix(spark, docs, keep=tuple(docs.columns))
    mixed = mixing.mixed_texts(documents, drawn).select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])
    return mixed.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else mixed


@tidy
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens.

    An empty text is its end token; equal ids are packed each on its own.
    """
    pieces = packing.pack(docs, ranks_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "ids")


STAGES = [("quality_classifier", keep_good), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies),
          ("source_mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, docs = Stage(spark), table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage.store(docs, name)
    return docs
