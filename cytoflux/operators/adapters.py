"""Adapter matching at the ends of reads, with errors and ``N`` as any base."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def written_out(adapter: str) -> tuple[str, int | None]:
    """An adapter in short form, as its bases and the least overlap: ``T{15}`` repeats a base, a leading X (which anchors) goes, ``;o=18`` is the overlap."""
    body, *settings = adapter.split(";")
    least = next((int(x[2:]) for x in settings if x.startswith("o=")), None)
    return re.sub(r"([A-Z])\{(\d+)\}", lambda m: m.group(1) * int(m.group(2)), body.removeprefix("X")), least


def wildcard_pattern(adapter: str) -> str:
    """An adapter as a regular expression: N is any base, ``T{15}`` repeats."""
    return written_out(adapter)[0].replace("N", "[ACGTN]")


def has_prefix(seq: Column, adapter: str, least: int) -> Column:
    """Exact match (but for N) of a suffix of the adapter, ``least`` bases at least, at the start of a read."""
    hit = F.lit(False)
    for k in range(len(adapter) - least + 1):
        hit = hit | seq.rlike("^" + wildcard_pattern(adapter[k:]))
    return hit


def prefix_errors(read: str, adapter: str, rate: float, least: int) -> int | None:
    """Bases of ``read`` that a suffix of ``adapter`` covers from the start with at most ``rate`` errors a base, or None.

    Edits are substitutions, insertions and deletions; the longest covered suffix of the adapter wins, then the fewest errors.
    """
    n, m = len(adapter), min(len(read), len(adapter) + int(rate * len(adapter)) + 1)
    # Row by row over the adapter from its end; any start within the adapter is free.
    best = None
    before = list(range(m + 1))
    starts = [0] * (m + 1)
    for i in range(1, n + 1):
        row, begin = [0] + [0] * m, [i] + [0] * m
        for j in range(1, m + 1):
            same = adapter[i - 1] == "N" or adapter[i - 1] == read[j - 1]
            options = ((before[j - 1] + (not same), starts[j - 1]), (before[j] + 1, starts[j]), (row[j - 1] + 1, begin[j - 1]))
            row[j], begin[j] = min(options)
        before, starts = row, begin
    for j in range(1, m + 1):
        covered = n - starts[j]
        if covered >= least and before[j] <= rate * covered:
            key = (covered, -before[j], -j)
            if best is None or key > best[0]:
                best = (key, j)
    return best[1] if best else None


def cuts_of(reads: list[str | None], adapter: str, rate: float, least: int) -> np.ndarray:
    """``prefix_errors`` of all reads at once, -1 for None: the same table, filled a column of reads at a time.

    A cell holds errors and the place in the adapter where the match begins, as one number, so the least number has the fewest errors.
    """
    n = len(adapter)
    width, unit = n + int(rate * n) + 1, n + 1
    texts = [(r or "")[:width] for r in reads]
    size = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(reads), width) if reads else np.zeros((0, width), np.uint32)
    before = [np.full(len(reads), j * unit) for j in range(width + 1)]
    for i, base in enumerate(adapter, 1):
        row = [np.full(len(reads), i)]
        for j in range(1, width + 1):
            wrong = 0 if base == "N" else (codes[:, j - 1] != ord(base)) * unit
            row.append(np.minimum(np.minimum(before[j - 1] + wrong, before[j] + unit), row[j - 1] + unit))
        before = row
    best, cut = np.full(len(reads), -1), np.full(len(reads), -1)
    for j in range(1, width + 1):
        errors, covered = before[j] // unit, n - before[j] % unit
        fine = (size >= j) & (covered >= least) & (errors <= rate * covered)
        key = np.where(fine, covered * unit * 4 + (unit * 4 - 1 - errors), -1)  # the longest first, then the fewest errors, then the shortest read
        better = key > best
        best, cut = np.where(better, key, best), np.where(better, j, cut)
    return cut


def match_prefix(reads: DataFrame, adapter: str, rate: float = 0.1, least: int = 10, seq: str = "seq") -> DataFrame:
    """Append ``trimmed`` (the read behind the adapter) and ``matched``; unmatched reads stay whole."""

    @F.pandas_udf("int")
    def cut(s: pd.Series) -> pd.Series:
        return pd.Series(cuts_of(s.tolist(), adapter, rate, least).astype(np.int32))

    at = cut(F.substring(seq, 1, len(adapter) + int(rate * len(adapter)) + 1))  # all that a match looks at
    t = reads.withColumn("cut", at)
    return t.withColumn("matched", F.col("cut") >= 0).withColumn("trimmed", F.expr(f"substring({seq}, greatest(cut, 0) + 1)")).drop("cut")


def with_adapter(reads: DataFrame, adapter: str, rate: float = 0.1, seq: str = "seq") -> DataFrame:
    """Reads that begin with an adapter in short form (see ``written_out``), untrimmed; all others go."""
    bases, least = written_out(adapter)

    @F.pandas_udf("boolean")
    def there(s: pd.Series) -> pd.Series:
        return pd.Series(prefix_hits(s.tolist(), bases, rate, least or len(bases)))

    return reads.where(there(F.substring(seq, 1, len(bases) + int(rate * len(bases)) + 1)))


def end_cuts(reads: list[str | None], adapter: str, rate: float = 0.1, least: int = 3) -> np.ndarray:
    """Where a 3' adapter begins in each read, -1 where it is not; all reads at once.

    The adapter stands whole somewhere in the read, or its first ``least`` bases or more at the read's end.  Edits are substitutions, insertions and deletions, at most
    ``rate`` for each covered base of the adapter that is not N; N fits any base.  To each end belongs the alignment with the fewest edits, of equals the
    one that begins first; of all that are allowed, that with the greatest number of covered bases less two for each edit wins, and of equals the one that begins first.

    A cell of the table holds edits and place of beginning as one number, so the least number is the alignment wanted.
    """
    texts = [r or "" for r in reads]
    size = np.array([len(t) for t in texts], np.int64)
    width, m = int(size.max(initial=0)), len(adapter)
    codes = np.array(texts, dtype=f"U{max(width, 1)}").view(np.uint32).reshape(len(texts), max(width, 1)).T.copy()
    unit = width + 1
    allowed = [rate * (i - adapter[:i].count("N")) for i in range(m + 1)]
    before = [np.full(len(texts), i * unit, np.int64) for i in range(m + 1)]  # before any base: the adapter's bases are all left out
    best = np.full(len(texts), -1, np.int64)
    cut = np.full(len(texts), -1, np.int64)

    def judge(column: list[np.ndarray], i: int, here: np.ndarray) -> None:
        edits, start = column[i] // unit, column[i] % unit
        key = (i - 2 * edits + 4 * m) * unit + (width - start)
        better = here & (edits <= allowed[i]) & (key > best)
        best[better], cut[better] = key[better], start[better]

    for j in range(1, width + 1):
        base, column = codes[j - 1], [np.full(len(texts), j, np.int64)]
        for i in range(1, m + 1):
            wrong = 0 if adapter[i - 1] == "N" else (base != ord(adapter[i - 1])) * unit
            column.append(np.minimum(np.minimum(before[i - 1] + wrong, before[i] + unit), column[i - 1] + unit))
        judge(column, m, size >= j)
        last = size == j
        if last.any():
            for i in range(max(least, 1), m):
                judge(column, i, last)
        before = column
    return cut


def trim_adapter_end(reads: DataFrame, adapter: str, rate: float = 0.1, least: int = 3, minimum: int = 0, seq: str = "seq", qual: str | None = None) -> DataFrame:
    """Reads cut where a 3' adapter begins (see ``end_cuts``), with their qualities; reads shorter than ``minimum`` afterwards go.  A null read stays null, and goes if there is a minimum."""

    @F.pandas_udf("int")
    def at(s: pd.Series) -> pd.Series:
        order = np.argsort(s.str.len().fillna(0).to_numpy(), kind="stable")  # reads of like length share a table
        out = np.full(len(s), -1, np.int32)
        texts = s.tolist()
        for i in range(0, len(order), 2048):
            rows = order[i : i + 2048]
            out[rows] = end_cuts([texts[k] for k in rows], adapter, rate, least)
        return pd.Series(out)

    t = reads.withColumn("_cut", at(F.col(seq)))
    for c in [seq, *([qual] if qual else [])]:
        t = t.withColumn(c, F.when(F.col("_cut") < 0, F.col(c)).otherwise(F.substring(F.col(c), F.lit(1), F.col("_cut"))))
    t = t.drop("_cut")
    return t.where(F.length(seq) >= minimum) if minimum else t


def tail_lengths(reads: list[str | None], base: str = "A", least: int = 3, rate: float = 0.2) -> np.ndarray:
    """The length of each read's tail of ``base``: a base of it adds 1, another takes 2 away; the end of the read with the greatest sum above 0, of which others are at
    most the share ``rate``, is the tail.  Of equals the shortest counts; tails below ``least`` are none."""
    texts = [(r or "")[::-1] for r in reads]
    size = np.array([len(t) for t in texts], np.int64)
    width = int(size.max(initial=0))
    if not width:
        return np.zeros(len(texts), np.int64)
    same = np.array(texts, dtype=f"U{width}").view(np.uint32).reshape(len(texts), width) == ord(base)
    places = np.arange(1, width + 1)
    there = places <= size[:, None]
    total = np.cumsum(np.where(same, 1, -2), axis=1)
    others = np.cumsum(~same, axis=1)
    fine = there & (others <= rate * places) & (total > 0)
    found = np.where(fine, total, 0)
    at = found.argmax(axis=1)
    n = np.where(found[np.arange(len(texts)), at] > 0, at + 1, 0)
    return np.where(n >= least, n, 0)


def trim_poly(reads: DataFrame, base: str = "A", head: bool = False, least: int = 3, minimum: int = 0, seq: str = "seq", qual: str | None = None) -> DataFrame:
    """Reads without their tail of ``base``, or with ``head`` without such a beginning (as poly-T of second reads), with their qualities; see ``tail_lengths``."""

    @F.pandas_udf("int")
    def length(s: pd.Series) -> pd.Series:
        texts = [x[::-1] if head and x else x for x in s.tolist()]
        return pd.Series(np.concatenate([tail_lengths(texts[i : i + 2048], base, least) for i in range(0, len(texts), 2048)] or [np.zeros(0)]).astype(np.int32))

    t = reads.withColumn("_n", length(F.col(seq)))
    for c in [seq, *([qual] if qual else [])]:
        rest = F.length(c) - F.col("_n")
        t = t.withColumn(c, F.substring(F.col(c), F.col("_n") + 1, rest) if head else F.substring(F.col(c), F.lit(1), rest))
    t = t.drop("_n")
    return t.where(F.length(seq) >= minimum) if minimum else t


def trim_tail(seq: Column, adapter: str, least: int = 3) -> Column:
    """Cut from the first whole adapter on, else a prefix of it (``least`` bases at least) at the end."""
    at = F.instr(seq, adapter)
    tails = "|".join(adapter[:k] for k in range(len(adapter) - 1, least - 1, -1))
    return F.when(at > 0, F.substring(seq, F.lit(1), at - 1)).otherwise(F.regexp_replace(seq, f"(?:{tails})$", ""))


def trim_homopolymer(seq: Column, base: str, least: int = 10) -> Column:
    """Cut a run of ``base`` at the 3' end."""
    return F.regexp_replace(seq, f"{base}{{{least},}}$", "")


def prefix_hits(reads: list[str | None], adapter: str, rate: float, least: int) -> np.ndarray:
    """Whether a suffix of ``adapter``, ``least`` bases at least, is a prefix of each read but for ``rate`` errors a base.

    Edits are substitutions, insertions and deletions.  N fits A, C, G, T and N, and allows no errors of its own.
    """
    size = np.array([len(r or "") for r in reads])
    width = len(adapter) + int(rate * len(adapter)) + 1
    codes = np.array([(r or "")[:width] for r in reads], dtype=f"U{width}").view(np.uint32).reshape(len(reads), width)
    is_base = np.isin(codes, [ord(c) for c in "ACGTN"])
    same = [(is_base if a == "N" else codes == ord(a)).T for a in adapter]
    hit = np.zeros(len(reads), bool)
    known = np.array([r is not None for r in reads])
    for begin in range(len(adapter) - least + 1):
        tail = adapter[begin:]
        most = int(rate * (len(tail) - tail.count("N")))
        todo = np.flatnonzero(known & ~hit & (size >= len(tail) - most))
        if not len(todo):
            continue
        far = np.full(len(todo), most + 1)  # also what lies behind the read's end or off the band
        before = {j: np.where(size[todo] >= j, j, far) for j in range(most + 1)}
        for i in range(1, len(tail) + 1):
            fits, row = same[begin + i - 1], {}
            for j in range(max(0, i - most), i + most + 1):
                cost = before.get(j, far) + 1
                if j:
                    cost = np.minimum(cost, row.get(j - 1, far) + 1)
                    cost = np.minimum(cost, before.get(j - 1, far) + ~fits[j - 1, todo])
                row[j] = np.where(size[todo] >= j, cost, far)
            before = row
        hit[todo] = np.min(list(before.values()), axis=0) <= most
    return hit


def demultiplex(reads: DataFrame, splits: dict[str, tuple[str, int]], seq: str = "seq", rate: float = 0.1) -> DataFrame:
    """One row per read and matching split (name to adapter and least overlap), from one scan.

    Adapters match with ``rate`` errors a base; those too short for an error are compared in Spark, all others in one Python pass.
    """
    tolerant = {k: v for k, v in splits.items() if int(rate * (len(v[0]) - v[0].count("N")))}
    parts = [F.array_compact(F.array(*[F.when(has_prefix(F.col(seq), a, n), F.lit(k)) for k, (a, n) in splits.items() if k not in tolerant]).cast("array<string>"))]
    if tolerant:
        width = max(len(a) + int(rate * len(a)) + 1 for a, _ in tolerant.values())

        @F.pandas_udf("array<string>")
        def found(s: pd.Series) -> pd.Series:
            texts = s.tolist()
            hits = {k: prefix_hits(texts, a, rate, n) for k, (a, n) in tolerant.items()}
            return pd.Series([[k for k in hits if hits[k][i]] for i in range(len(texts))], dtype=object)

        parts.append(found(F.substring(seq, 1, width)))
    return reads.withColumn("split", F.explode(F.concat(*parts)))
