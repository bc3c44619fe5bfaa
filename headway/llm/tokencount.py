"""Token counts of flat, unindexed token files by a separator scan.

A token file is nothing but ids, one after the other, in which every document
ends with a separator id. Files are read in blocks, wherever these begin; a
vectorised search gives the places of the separators in each block. A document
that began in an earlier block is stitched by a prefix scan over the blocks'
summaries: the last separator before a block, and how many there were. The scan
has two levels, blocks within groups and groups within a file, so that a huge
file is not one task's work.

Ids after the last separator of a file are a document without an end
(``ended`` is false). Files without ids give no rows. A file that isn't a whole
number of ids is an error.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.llm.frames import written
from headway.llm.tokenfiles import encoded, encoder, open_uri
from headway.session import work_path

#: Ids of a block, and blocks of a group.
BLOCK_IDS, GROUP = 1 << 22, 1024


def write_flat(docs: DataFrame, path: str, folder: str, end_id: int, id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """Writes the ids of all texts as flat 16- or 32-bit files in ``folder``, each
    text closed by ``end_id``, one file for each partition of ``docs`` in its
    order. Returns the order, stored: (file, ordinal, id).

    Strings of special tokens in a text are ordinary text, so ``end_id`` only
    stands at ends. Null and empty texts have the end alone.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = open_uri(folder)
        end = np.array([end_id], dtype=id_type(path)).tobytes()
        name, stream, ordinal = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.ids", None, 0
        for batch in batches:
            stream = stream or files.open_output_stream(posixpath.join(root, name))
            for ids in encoded(path, batch.column(1), special_as_text=True):
                stream.write(ids.tobytes() + end)
            rows = np.arange(ordinal, ordinal + len(batch))
            ordinal += len(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(batch)), pa.array(rows, pa.int64()), batch.column(0)],
                names=["file", "ordinal", "id"],
            )
        if stream is not None:
            stream.close()

    files, root = open_uri(folder)
    files.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return written(rows.mapInArrow(run, f"file string, ordinal bigint, id {kind}"), "token-order")


def id_type(path: str) -> str:
    return encoder(path, special_as_text=True).dtype.str


def blocks(spark: SparkSession, folder: str, names: DataFrame, dtype: str, block_ids: int) -> DataFrame:
    """(file, block, begin, ids): the blocks of the files named in column ``file``."""
    width = np.dtype(dtype).itemsize

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        for batch in batches:
            own = batch.column(0).to_pylist()
            found = [files.get_file_info(posixpath.join(root, n)).size for n in own]
            for name, size in zip(own, found):
                if size is None or size % width:
                    raise ValueError(f"{name}: no file of whole {dtype} ids")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s // width for s in found], pa.int64())], names=["file", "total"]
            )

    whole = names.mapInArrow(sizes, "file string, total bigint").where("total > 0")
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / block_ids)))
    cut = whole.select("file", "total", number.alias("block"))
    begin = F.col("block") * block_ids
    return cut.select("file", "block", begin.alias("begin"),
                      F.least(F.lit(block_ids).cast("bigint"), F.col("total") - begin).alias("ids"))


def separators(cut: DataFrame, folder: str, dtype: str, end_id: int) -> DataFrame:
    """(file, block, begin, ids, ends): the places in the file of the separators
    of each block."""
    width = np.dtype(dtype).itemsize

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(posixpath.join(root, row["file"])) as file:
                    data = np.frombuffer(file.read_at(row["ids"] * width, row["begin"] * width), np.dtype(dtype))
                ends = np.flatnonzero(data == end_id) + row["begin"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]]) for c in ("file", "block", "begin", "ids")]
                    + [pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "begin", "ids", "ends"],
                )

    return cut.mapInArrow(search, "file string, block bigint, begin bigint, ids bigint, ends array<bigint>")


def _carried(found: DataFrame) -> DataFrame:
    """(file, block, start, ordinal): where the document that a block begins in
    has begun, and its number in the file."""
    summary = found.select(
        "file", "block", F.floor(F.col("block") / GROUP).alias("group"),
        F.array_max("ends").alias("last"), F.size("ends").cast("bigint").alias("n"),
    )

    def before(window):
        return [F.max("last").over(window).alias("last_before"), F.coalesce(F.sum("n").over(window), F.lit(0)).alias("n_before")]

    groups = summary.groupBy("file", "group").agg(F.max("last").alias("last"), F.sum("n").alias("n"))
    far = W.partitionBy("file").orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    near = W.partitionBy("file", "group").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    groups = groups.select("file", "group", *before(far)).withColumnsRenamed(
        {"last_before": "last_far", "n_before": "n_far"}
    )
    own = summary.select("file", "group", "block", *before(near)).join(groups, ["file", "group"])
    last = F.greatest("last_before", "last_far")  # null before the first separator
    return own.select("file", "block", F.coalesce(last + 1, F.lit(0)).alias("start"),
                      (F.col("n_before") + F.col("n_far")).alias("ordinal"))


def documents(spark: SparkSession, folder: str, names: DataFrame, dtype: str, end_id: int,
              block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended): the documents of the files named in
    column ``file``; ``n_tokens`` counts the separator too."""
    cut = blocks(spark, folder, names, dtype, block_ids)
    found = written(
        separators(cut.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), folder, dtype, end_id),
        "token-separators",
    )
    carried = _carried(found)
    joined = found.join(carried, ["file", "block"])
    ended = joined.select("file", "start", "ordinal", "ends", F.posexplode("ends").alias("k", "end")).select(
        "file", (F.col("ordinal") + F.col("k")).alias("ordinal"),
        F.when(F.col("k") == 0, F.col("start")).otherwise(F.try_element_at("ends", F.col("k")) + 1).alias("start"),
        "end",
    )
    ended = ended.select("file", "ordinal", "start", (F.col("end") + 1 - F.col("start")).alias("n_tokens"),
                         F.lit(True).alias("ended"))
    # The last block of a file, if ids follow its last separator.
    tails = joined.groupBy("file").agg(
        F.max(F.struct("block", F.greatest("start", F.coalesce(F.array_max("ends") + 1, F.lit(0))).alias("start"),
                       (F.col("ordinal") + F.size("ends")).alias("ordinal"),
                       (F.col("begin") + F.col("ids")).alias("total"))).alias("t")
    ).select("t.*", "file").where("total > start")
    return ended.unionAll(tails.select("file", "ordinal", "start", (F.col("total") - F.col("start")).alias("n_tokens"),
                                       F.lit(False).alias("ended")))


def counts_of_texts(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: id, file, ordinal, start and n_tokens, counted from
    flat files that are written for it."""
    spark = docs.sparkSession
    folder = work_path(spark, "flat-tokens")
    order = write_flat(docs, path, folder, end_id, id_column, text_column)
    found = documents(spark, folder, order.select("file").distinct(), id_type(path), end_id)
    return order.join(found, ["file", "ordinal"]).select(
        F.col("id").alias(id_column), "file", "ordinal", "start", "n_tokens"
    )
