"""A batch and streaming data source of FASTQ files; gzip files are one partition each."""

from __future__ import annotations

import glob
import gzip
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, ord bigint, read_id string, comment string, seq string, qual string"


def records(lines: Iterator[str], name: str) -> Iterator[tuple]:
    """Four lines a record; a truncated or malformed record is an error."""
    for ord_, head in enumerate(lines):
        body = [next(lines, None) for _ in range(3)]
        head = head.rstrip("\r\n")
        if None in body:
            raise ValueError(f"{name}: truncated record {ord_}")
        seq, plus, qual = (x.rstrip("\r\n") for x in body)
        if not head.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
            raise ValueError(f"{name}: malformed record {ord_}")
        read_id, _, comment = head[1:].partition(" ")
        yield name, ord_, read_id, comment, seq, qual


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.paths = sorted(p for pattern in path.split(",") for p in (glob.glob(os.path.join(pattern, "*.f*q*")) if os.path.isdir(pattern) else glob.glob(pattern)))

    def partitions(self) -> list[_File]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[tuple]:
        opened = gzip.open if partition.path.endswith(".gz") else open
        with opened(partition.path, "rt") as f:
            yield from records(f, partition.path)


class FastqSource(DataSource):
    """``spark.read.format("fastq").load(path)``; the path must be a folder that executors see."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastqSource)
