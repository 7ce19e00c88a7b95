"""Text files whose lines belong together, read by splits: what a line needs of the lines before it is carried over.

Spark's text reader cuts plain files into splits and gives a split's lines in order. Within a split, values are carried forward
batch by batch, without a shuffle; each split's last values, one small row a split, are summed up along its file and
joined to the next splits' rows. A gzip file is one split, whatever its size, and streams.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

#: The column that marks a split's first line, within this module.
OPENS = "_opens"


def lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """``(file, split, id, value)``: lines (or what lies between separators), where the split starts, and a number that grows within it.

    Use it as it comes from here: a shuffle would take the lines out of their order.
    """
    read = spark.read.option("lineSep", separator).text(path)
    value = F.regexp_replace("value", "\\r$", "") if separator == "\n" else F.col("value")
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), value.alias("value"))


def runs(batch: pa.RecordBatch, keys: tuple[str, ...] = ("file", "split")) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The batch by runs of equal keys."""
    n = batch.num_rows
    new = [0] if n else []
    if n > 1:
        differs = None
        for k in keys:
            c = batch.column(k)
            d = pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True)
            differs = d if differs is None else pc.or_(differs, d)
        new += [i + 1 for i in pc.indices_nonzero(differs).to_pylist()]
    for x, y in zip(new, [*new[1:], n]):
        yield tuple(batch.column(k)[x].as_py() for k in keys), batch.slice(x, y - x)


def _filled(rows: DataFrame, last: tuple[str, ...], before: tuple[str, ...], counts: tuple[str, ...]) -> DataFrame:
    """The carried columns as far as the split itself tells them."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, {}
        for batch in batches:
            for own, part in runs(batch):
                if own != key:
                    key, state = own, {}
                columns = dict(zip(part.schema.names, part.columns))
                n = part.num_rows
                opens = pa.array([not state] + [False] * (n - 1))
                state.setdefault("", True)
                for c in last:
                    filled = pc.fill_null_forward(columns[c])
                    columns[c] = filled if state.get(c) is None else pc.fill_null(filled, state[c])
                    state[c] = columns[c][n - 1].as_py()
                for c in before:
                    kind = columns[c].type
                    shifted = pa.concat_arrays([pa.array([state.get(c)], kind), columns[c].slice(0, n - 1)])
                    state[c], columns[c] = columns[c][n - 1].as_py(), shifted
                for c in counts:
                    columns[c] = pc.add(pc.cumulative_sum(columns[c]), state.get(c, 0))
                    state[c] = columns[c][n - 1].as_py()
                yield pa.RecordBatch.from_arrays([*columns.values(), opens], names=[*columns, OPENS])

    return rows.mapInArrow(fill, StructType([*rows.schema.fields, StructField(OPENS, BooleanType())]))


def carry(rows: DataFrame, last: tuple[str, ...] = (), before: tuple[str, ...] = (), counts: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (from ``lines``, with columns added) with these columns replaced by what the file tells up to each line.

    ``last``: the last value that isn't null, this line's included; ``before``: the value of the line right before; ``counts``:
    the running sum, this line included. Null where there is nothing before; files don't know of each other.
    """
    ends = rows.groupBy("file", "split").agg(
        F.lit(True).alias("_known"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("id"))).alias(f"_last_{c}") for c in last],
        *[F.max_by(c, "id").alias(f"_before_{c}") for c in before],
        *[F.sum(c).alias(f"_sum_{c}") for c in counts],
    )
    along = Window.partitionBy("file").orderBy("split")
    past = along.rowsBetween(Window.unboundedPreceding, -1)
    known = ends.select(
        "file", "split", "_known",
        *[F.last(f"_last_{c}", ignorenulls=True).over(past).alias(f"_last_{c}") for c in last],
        *[F.lag(f"_before_{c}").over(along).alias(f"_before_{c}") for c in before],
        *[F.coalesce(F.sum(f"_sum_{c}").over(past), F.lit(0)).alias(f"_sum_{c}") for c in counts],
    )
    joined = _filled(rows, last, before, counts).join(known, ["file", "split"], "left")
    found = F.when(F.col("_known").isNull(), F.raise_error(F.lit("the files were cut into other splits meanwhile")).cast("string")).otherwise(F.col("file"))
    new = {c: F.coalesce(c, f"_last_{c}") for c in last}
    new |= {c: F.when(F.col(OPENS), F.col(f"_before_{c}")).otherwise(F.col(c)) for c in before}
    new |= {c: F.col(c) + F.col(f"_sum_{c}") for c in counts} | {"file": found}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in rows.columns])
