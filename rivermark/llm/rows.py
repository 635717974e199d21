"""Row identity, free column names and shared tables for the operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark.session import shared_folder


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(id_column: str, text_column: str) -> Column:
    """A document is its id and its text: repeated rows are one document, rows that only share an id are not."""
    return F.struct(
        col(id_column).alias("id"), F.xxhash64(col(text_column), F.length(col(text_column))).alias("text")
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither
    compute it twice nor depend on the executors that made it."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fitting_rows(texts: DataFrame, group: str, characters: int) -> DataFrame:
    """Rows of ``texts`` (text, place, more) that a group has room for, taken by place: a text that does not fit is
    left out and the next ones may fit. If no text with characters fits, the shortest stays. Groups are
    samples of a bounded number of rows; only their sizes meet in one task."""
    rows = stored(texts.withColumn("row", F.monotonically_increasing_id()), "sample-rows")
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    sizes = rows.select(group, "row", "place", F.xxhash64("text").alias("tie"), size.alias("size"))

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("tie", "ascending"), ("row", "ascending")])
        room, chosen, some = characters, [], False
        pairs = list(zip(table.column("size").to_pylist(), table.column("row").to_pylist()))
        for size, row in pairs:
            if size <= room:
                room, some = room - size, some or size > 0
                chosen.append(row)
        if not some and any(size for size, _ in pairs):
            chosen.append(min((pair for pair in pairs if pair[0]), key=lambda pair: pair[0])[1])
        return pa.table({"row": pa.array(chosen, pa.int64())})

    picked = sizes.groupBy(group).applyInArrow(choose, "row long")
    return rows.join(picked, "row", "left_semi").drop("row")


def in_training(id_column: str, modulus: int, held_out: int) -> Column:
    """Whether crc32 of the id as text leaves another remainder than ``held_out``; a null id trains."""
    return F.coalesce(F.crc32(col(id_column).cast("string").cast("binary")) % modulus != held_out, F.lit(True))

