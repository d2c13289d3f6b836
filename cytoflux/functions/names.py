"""Column functions over sample names, read ids, barcodes and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_code(name: Column) -> Column:
    """``C`` and the first 16 hex digits of the name's SHA-256."""
    return F.concat(F.lit("C"), F.substring(F.sha2(name.cast("binary"), 256), 1, 16))


def umi_of(seq: Column, length: int = 8) -> Column:
    return F.substring(seq, 1, length)


def tagged_read_id(read_id: Column, code: Column) -> Column:
    """Insert a cell's code before the 8-base UMI at the end of a read id."""
    umi = F.regexp_extract(read_id, r"_([ACGTNacgtn]{8})$", 1)
    return F.when(umi != "", F.concat(F.regexp_replace(read_id, r"_[ACGTNacgtn]{8}$", ""), F.lit("_"), code, F.lit("_"), umi))


def read_id_parts(read_id: Column) -> Column:
    """Struct of prefix, cell_code, umi; null where the id has another form."""
    pattern = r"^(.+)_(C[0-9a-f]{16})_([ACGTN]{8})$"
    part = lambda k: F.regexp_extract(read_id, pattern, k)
    return F.when(read_id.rlike(pattern), F.struct(part(1).alias("prefix"), part(2).alias("cell_code"), part(3).alias("umi")))


def mate_suffix(header: Column) -> Column:
    """``/1`` and ``/2`` at the end become `` 1`` and `` 2``."""
    return F.regexp_replace(header, r"/([12])$", " $1")


def path_part(path: Column, n: int, suffix: str = "") -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), n), suffix, "") if suffix else F.element_at(F.split(path, "/"), n)


def safe_name(index: Column, chrom: Column) -> Column:
    return F.concat(F.lpad(index.cast("string"), 4, "0"), F.lit("_"), F.regexp_replace(chrom, r"[^A-Za-z0-9._-]", "_"))


def gigabases(reads: Column, pair_bases: int = 300) -> Column:
    return reads / 2 * pair_bases / 1e9


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def truncated(value: Column, digits: int = 4) -> Column:
    """Cut, not rounded, after ``digits`` decimals."""
    return F.floor(value * 10**digits) / 10**digits


def plain_number(value: Column, digits: int = 10) -> Column:
    """A number with at most ``digits`` decimals, without trailing zeros; ``0`` for zero."""
    shown = F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}f", value.cast("double")), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(value.isNotNull(), shown)


def one_hot_phase(p: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == p, 1.0).otherwise(0.0))


def natural_key(name: Column) -> Column:
    """A text whose plain order is the natural order of names: runs of digits compare as numbers, all else by character, and a name before the names it begins.

    A run becomes a ``0``, its length without leading zeros in six digits, and these digits, so it compares with other characters as a digit does.  Names that differ in leading zeros alone
    have equal keys.
    """
    parts = F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))

    def shown(x: Column) -> Column:
        number = F.regexp_replace(x, "^0+", "")
        return F.when(x.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(number).cast("string"), 6, "0"), number)).otherwise(x)

    return F.array_join(F.transform(parts, shown), "")
