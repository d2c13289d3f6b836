"""The cohort: discovery of paired inputs, cell codes, checks of expected and found sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import cell_code
from ..sources.scratch import written

NAME = r"^[A-Za-z0-9][A-Za-z0-9._-]*$"


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Cells below ``folder``: one sub-folder each with the files ``<cell>_1.fq.gz`` and ``<cell>_2.fq.gz``, or ``_R1`` and ``_R2``; columns sample_name, safe_code, r1, r2, ord.

    Only the listing is read, not the files; names that begin with a dot do not count.  An error: a FASTQ file of another name, not one pair, both schemes in a folder, a
    bad name, two folders of one name, two cells of one code.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    part = F.split("path", "/")
    files = files.select("path", F.element_at(part, -2).alias("sample_name"), F.element_at(part, -1).alias("file"), F.array_join(F.slice(part, F.lit(1), F.size(part) - 1), "/").alias("folder"))
    files = files.where(F.col("file").rlike(r"[.](fq|fastq)[.]gz$"))
    ending = F.when(F.startswith("file", "sample_name"), F.expr("substring(file, length(sample_name) + 1)"))
    files = files.withColumn("mate", F.regexp_extract(F.coalesce(ending, F.lit("")), r"^_(R?[12])[.]fq[.]gz$", 1))
    path = lambda *mates: F.max(F.when(F.col("mate").isin(*mates), F.col("path")))
    cells = files.groupBy("folder", "sample_name").agg(F.sort_array(F.collect_set("mate")).alias("mates"), F.count("*").alias("n"), path("1", "R1").alias("r1"), path("2", "R2").alias("r2"))
    fault = (
        F.when(~F.array_join("mates", " ").isin("1 2", "R1 R2") | (F.col("n") != 2), "not one pair of files, or names of other files: ")
        .when(~F.col("sample_name").rlike(NAME), "a bad name: ")
        .when(F.col("folders") > 1, "two folders of one name: ")
        .when(F.col("same_code") > 1, "two cells of one code: ")
    )
    cells = cells.withColumn("safe_code", cell_code(F.col("sample_name")))
    cells = cells.join(cells.groupBy("sample_name").agg(F.count("*").alias("folders")), "sample_name")
    cells = cells.join(cells.groupBy("safe_code").agg(F.count_distinct("sample_name").alias("same_code")), "safe_code")
    name = F.when(fault.isNull(), F.col("sample_name")).otherwise(F.raise_error(F.concat(fault, F.col("sample_name"))))
    return with_order(cells.select(name.alias("sample_name"), "r1", "r2", "safe_code"))


def with_order(cells: DataFrame, by: tuple[str, ...] = ("sample_name",), start: int = 0) -> DataFrame:
    """Append ``ord``, the place of a row by ``by``, from ``start``: a range-partitioned table, stored so that each row keeps its part, and the counts of earlier parts."""
    d = written(cells.repartitionByRange(*[F.col(c) for c in by]).withColumn("part", F.spark_partition_id()), "ranged")
    counts = d.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("part").orderBy(*by))
    return d.withColumn("place", place).join(F.broadcast(before), "part").withColumn("ord", (F.col("before") + F.col("place") - 1 + start).cast("int")).drop("part", "place", "before")  # a row per part


def named(counts: DataFrame, cells: DataFrame, code: str = "cell_code") -> DataFrame:
    """Replace codes by sample names; an unknown code is an error."""
    known = cells.select(F.col("safe_code").alias(code), "sample_name")
    name = F.when(F.col("sample_name").isNotNull(), F.col("sample_name")).otherwise(F.raise_error(F.concat(F.lit("unknown cell code "), F.col(code))))
    return counts.join(known, code, "left").withColumn("sample_name", name)


def missing_targets(targets: DataFrame, listing: DataFrame) -> DataFrame:
    """Enabled targets (path) whose file (path, length) is missing or empty."""
    there = listing.where("length > 0").select("path")
    return targets.where("enabled").join(there, "path", "left_anti")


def matrix_receipt(cells: DataFrame, observed: DataFrame, rows: int, contract: str, code: str = "cell_code") -> DataFrame:
    """The receipt of a matrix of the whole cohort, one row: expected and observed cells, those filled with zeros (codes and names, comma-joined, or ``none``), and its rows.

    ``cells`` have sample_name, safe_code and ord; a column of ``observed`` that is no cell's is an error.
    """
    seen = observed.select(F.col(code).alias("safe_code")).distinct().withColumn("seen", F.lit(True))
    both = cells.select("sample_name", "safe_code", "ord").join(seen, "safe_code", "full")
    unknown = F.col("ord").isNull()
    both = both.where(F.when(unknown, F.raise_error(F.concat(F.lit("a column of no cell: "), F.col("safe_code"))).cast("boolean")).otherwise(True))
    gone = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("seen").isNull(), F.struct("ord", c)))), lambda x: x[c]), ",")
    t = both.agg(F.count("*").alias("expected_cells"), F.count("seen").alias("observed_cells"), F.count_if(F.col("seen").isNull()).alias("missing_cells_filled_zero"), gone("safe_code").alias("codes"), gone("sample_name").alias("names"))
    shown = lambda c: F.when(F.col(c) == "", "none").otherwise(F.col(c))
    return t.select(F.lit(contract).alias("contract_sha256"), "expected_cells", "observed_cells", "missing_cells_filled_zero", F.lit(0).alias("unexpected_cells"), shown("codes").alias("missing_cell_codes"), shown("names").alias("missing_cell_names"), F.lit(rows).alias("feature_rows"), F.lit("PASS").alias("cell_column_contract"))
