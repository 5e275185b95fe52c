"""CSV whose quoted texts may hold line breaks, read by many tasks however large a file is.

Spark's text source cuts a file into blocks of whole lines. Whether a block begins inside a quoted
text follows from the number of quotes before it: a first pass counts the quotes of each block, and
a running sum over the blocks of a file (one row each) gives the state at its start. In the second
pass each task joins the lines of the records that begin and end in its block; the pieces of
records that cross blocks, two a block at most, are put together by their order. Records are then
parsed by Spark's own CSV function.

Texts with line breaks, separators or quotes are quoted, and quotes inside are doubled, as
spreadsheets write them. A quote elsewhere in an unquoted text is an error, since blocks could
not be told apart. Lines end in a line feed, with or without a carriage return. Every file has a
header, which is left out; empty lines are skipped. Without files there is Spark's error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlark.session import materialize

#: A whole record, the tail of a block that goes on, and what goes on from the block before: to its end, or through the whole block.
WHOLE, TAIL, HEAD, THROUGH = 0, 1, 2, 3
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
WELL_QUOTED = f"(?s)^{_FIELD}(?:,{_FIELD})*+$"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, block, quotes) of all lines, in order inside each block."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), quotes.alias("quotes"))


def block_states(found: DataFrame) -> DataFrame:
    """(file, block, inside): whether each block of lines begins inside a quoted text; a written table."""
    counts = materialize(found.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")), "blocks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record, file, block, first) of all records; `first` is the first one of a file."""
    found = lines(spark, path)
    # One row per block.
    placed = found.join(F.broadcast(block_states(found)), ["file", "block"]).select("line", "file", "block", "quotes", "inside")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, begun, held, fresh = None, 0, True, [], False

        def piece(texts: pa.Array | list[str], kind: int) -> pa.RecordBatch:
            nonlocal fresh
            n = len(texts)
            first = np.zeros(n, bool)
            first[0], fresh = fresh, False
            columns = [texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array([kind] * n, pa.int8()), pa.array(first)]
            return pa.RecordBatch.from_arrays(columns, ["record", "file", "block", "kind", "first"])

        for batch in batches:
            if not batch.num_rows:
                continue
            files, blocks = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
            names = files.indices.to_numpy()
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                here = (files.dictionary[names[a]].as_py(), int(blocks[a]))
                if here != at:
                    if held:
                        yield piece(["\n".join(held)], TAIL if begun else THROUGH)
                    at, inside, held, fresh = here, batch.column(4)[a].as_py(), [], here[1] == 0
                    begun = not inside
                part = batch.column(0).slice(a, b - a)
                odd = batch.column(3).slice(a, b - a).to_numpy() % 2 == 1
                if not inside and not odd.any():
                    yield piece(part, WHOLE)
                    continue
                whole: list[str] = []
                for line, turns in zip(part.to_pylist(), odd.tolist(), strict=True):
                    inside ^= turns
                    if not inside and not held and begun:
                        whole.append(line)
                        continue
                    held.append(line)
                    if not inside:
                        text = "\n".join(held)
                        if begun:
                            whole.append(text)
                        else:
                            yield piece([text], HEAD)
                        held, begun = [], True
                if whole:
                    yield piece(whole, WHOLE)
        if held:
            yield piece(["\n".join(held)], TAIL if begun else THROUGH)

    pieces = placed.mapInArrow(run, "record string, file string, block long, kind tinyint, first boolean")
    parts = materialize(pieces.where(F.col("kind") != WHOLE), "record-pieces")
    # A block has its head before its tail.
    ordered = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == TAIL, 1).otherwise(0))
    numbered = parts.withColumn("n", F.sum((F.col("kind") == TAIL).cast("int")).over(ordered)).withColumn("k", F.row_number().over(ordered))
    joined = numbered.groupBy("file", "n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "record"))), lambda x: x["record"]), "\n").alias("record"),
        F.min("block").alias("block"),
        F.max("first").alias("first"),
    )
    columns = ["record", "file", "block", "first"]
    return pieces.where(F.col("kind") == WHOLE).select(*columns).unionByName(joined.select(*columns))


def read_quoted(spark: SparkSession, path: str, schema: StructType, options: dict, check_header: bool = False) -> DataFrame:
    """The rows of CSV files with a header each, in the columns of `schema`; runs jobs.

    With `check_header` the header must name the columns in this order.
    """
    found = records(spark, path).withColumn("record", F.rtrim("record", F.lit("\r"))).where("record <> ''")
    stray = F.contains("record", F.lit('"')) & ~F.rlike("record", F.lit(WELL_QUOTED))
    error = F.concat(F.lit("a quote stands inside an unquoted text: "), F.substring("record", 1, 200))
    found = found.withColumn("record", F.when(stray, F.raise_error(error).cast("string")).otherwise(F.col("record")))
    settings = {k: str(v) for k, v in options.items() if k != "header"} | {"multiLine": "true"}
    if check_header:
        texts = ", ".join(f"c{k} string" for k in range(len(schema)))
        heads = found.where("first").select(F.from_csv("record", F.lit(texts), settings).alias("r")).select("r.*").distinct()
        for row in heads.limit(2).collect():
            if list(row) != schema.names:
                raise ValueError(f"the header {list(row)} is not {schema.names}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return found.where("not first").select(F.from_csv("record", F.lit(ddl), settings).alias("r")).select("r.*")
