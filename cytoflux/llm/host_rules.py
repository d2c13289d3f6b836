"""Quality rules whose verdicts are shared by the documents of a host.

Each document gets counts over its whole text, a base verdict, and the answers of several rules.  Failures of each rule are added
up by host, each host's failure rate is shrunk towards all hosts by a beta prior that is
fitted to the hosts themselves, and the prior also says from which rate on a host is bad: far above what it expects of a host, within fixed
bounds.  A host that is bad under any rule takes all of its documents with it.  Host sums are pre-aggregated before the shuffle, so a
host that holds a third of all rows sends one row per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rows_where, stored, unused, with_columns_from

#: A host goes when its shrunk rate is above the prior's mean by so many of its deviations, but not below the first bound and surely above the second.
DEVIATIONS, HOST_LIMITS = 4.0, (0.3, 0.5)
MIN_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
COUNTS = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "n_lines": "long"}
#: What a document fails, over its counts; each is judged by host.  The same text is SQL.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "word_length": "word_chars > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}
#: A document that fails one of these goes, whatever its host.
BASE_RULES = ("few_words", "repeats")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _repeat_words(words: list[list[bytes]]) -> np.ndarray:
    """For each text the words in windows of five that occur twice or more in it."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    if not total:
        return np.zeros(len(words), dtype=np.int64)
    flat = [w for ws in words for w in ws]
    number = {w: i for i, w in enumerate(set(flat), 1)}
    ids = np.fromiter(map(number.__getitem__, flat), np.uint64, total)
    text = np.repeat(np.arange(len(words)), sizes)
    covered = np.zeros(total, dtype=bool)
    if total >= WINDOW:
        inside = text[: total - WINDOW + 1] == text[WINDOW - 1 :]
        starts = np.flatnonzero(inside)
        key = (text[starts].astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)  # texts stay apart
        key ^= key >> np.uint64(32)
        for k in range(WINDOW):
            key = (key + ids[starts + k]) * _MULTIPLIERS[k]
            key ^= key >> np.uint64(29)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        one, other = starts[order[1:][same]], starts[order[:-1][same]]
        if (text[one] != text[other]).any() or any((ids[one + k] != ids[other + k]).any() for k in range(WINDOW)):
            # Different windows share a hash: number the windows exactly instead, a word at a time.
            key = text[starts]
            for k in range(WINDOW):
                key = np.unique(key.astype(np.int64) * (len(number) + 1) + ids[starts + k].astype(np.int64), return_inverse=True)[1]
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(starts), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        for k in range(WINDOW):
            covered[starts[twice] + k] = True
    return np.bincount(text[covered], minlength=len(words)).astype(np.int64)


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word that are equal to an earlier one, and all lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines)), len(lines)


def _make():
    def compute(column: pa.Array):
        texts = [x or "" for x in column.to_pylist()]
        words = [x.encode().split() for x in texts]
        lines = [_lines(x) for x in texts]
        return (
            [len(w) for w in words],
            [len(x) - sum(map(x.count, SPACES)) for x in texts],
            [sum(map(x.count, SYMBOLS)) for x in texts],
            [x[0] for x in lines],
            _repeat_words(words),
            [x[1] for x in lines],
        )

    return compute


#: Hosts that are broadcast at most, after a count, and parts of the rows that more hosts go out to.
HOSTS, SALTS = 1_000_000, 32


def _base_failed() -> Column:
    return F.expr(" OR ".join(f"({RULES[r]})" for r in BASE_RULES))


def document_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append the counts and ``base_failed``; a null text counts as having no word."""
    return with_columns_from(docs, [text], COUNTS, _make).withColumn("base_failed", _base_failed())


def host_verdicts(counted: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: its documents ``n``, for each rule failures, shrunk rate (``_rate``) and verdict (``_failed``), and the bad rules, ``host_rules``.

    The prior of a rule is Beta(a, b) with the mean and the excess variance of the hosts' rates
    (method of moments, hosts weighted by size).  Without excess variance the prior is as
    strong as a million documents.  Documents with a null host are one host.
    """
    sums = [F.count_if(F.expr(f"{text}")).alias(f"{rule}_n") for rule, text in RULES.items()]
    hosts = stored(counted.groupBy(F.col(f"`{host}`").alias("host")).agg(F.count("*").alias("n"), *sums))
    whole = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("h"), *[F.sum(f"{r}_n").alias(r) for r in RULES]).first()
    n, h = whole["n"] or 1, whole["h"]
    mean = {r: (whole[r] or 0) / n for r in RULES}
    rate = lambda r: F.col(f"{r}_n") / F.col("n")
    spread = hosts.agg(*[(F.sum(F.col("n") * (rate(r) - mean[r]) * (rate(r) - mean[r])) / F.sum("n")).alias(r) for r in RULES]).first()
    out = hosts
    for r in RULES:
        m = mean[r]
        excess = (spread[r] or 0.0) - m * (1 - m) * max(h - 1, 0) / n
        strength = 1e6 if excess <= 0 else min(max(m * (1 - m) / excess - 1, 1.0), 1e6)
        limit = min(max(m + DEVIATIONS * (m * (1 - m) / (strength + 1)) ** 0.5, HOST_LIMITS[0]), HOST_LIMITS[1])
        shrunk = (F.col(f"{r}_n") + m * strength) / (F.col("n") + strength)
        out = out.withColumn(f"{r}_rate", shrunk).withColumn(f"{r}_failed", shrunk > limit)
    return out.withColumn("host_rules", F.concat_ws(",", *[F.when(F.col(f"{r}_failed"), r) for r in RULES]))


def _with_hosts(rows: DataFrame, hosts: DataFrame, host: str, how: str) -> DataFrame:
    """``rows`` joined with a table of hosts (its first column, null or not); a host's rows may be a third of all.

    The table is broadcast if a count finds it small; else it goes out once to each of ``SALTS`` parts of the rows.
    """
    name = hosts.columns[0]
    if hosts.limit(HOSTS + 1).count() <= HOSTS:
        return rows.join(F.broadcast(hosts), rows[host].eqNullSafe(hosts[name]), how)
    salt, copy = unused(rows, "salt"), unused(rows, "salt_of_host")
    salted = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    many = hosts.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(many, salted[host].eqNullSafe(many[name]) & (salted[salt] == many[copy]), how).drop(salt, copy)


def judge(docs: DataFrame, host: str = "source", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Verdicts for all rows of ``docs``: keys, counts, ``base_failed``, ``host_failed``, ``host_rules``, ``kept``.

    Nulls: a null text has no word and fails; documents without a host share one verdict;
    a null id keeps its row.  Repeated rows are judged one by one.  An empty table gives an
    empty result.  Other columns of ``docs`` are not read.
    """
    names = list(dict.fromkeys([*keys, host]))
    counted = stored(document_counts(docs.select(*names, "text")).select(*names, *COUNTS, "base_failed"))
    hosts = host_verdicts(counted, host).select("host", "host_rules")
    joined = _with_hosts(counted, stored(hosts.withColumnRenamed("host", unused(counted, "host_key"))), host, "left")
    failed = F.col("host_rules") != ""
    return joined.select(*keys, *COUNTS, "base_failed", failed.alias("host_failed"), "host_rules", (~F.col("base_failed") & ~failed).alias("kept"))


def kept_documents(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the columns of ``docs``; the same verdicts as ``judge``.

    Counted once: documents with their counts are written, as the verdicts of hosts need all of them first.
    """
    taken = [*COUNTS, "base_failed"]
    aside = {c: unused(docs, f"{c}_input") for c in docs.columns if c in taken}
    counted = stored(document_counts(docs.withColumnsRenamed(aside)))
    host = aside.get(host, host)
    failed = host_verdicts(counted, host).where("host_rules <> ''").select(F.col("host").alias(unused(counted, "failed_host")))
    fine = _with_hosts(counted.where("NOT base_failed"), stored(failed), host, "left_anti")
    return fine.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def op8_host_rules(spark, sf_dir):
    from .common import table

    return judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def _verdicts_sql() -> str:
    each = lambda f, sep=", ": sep.join(f(r) for r in RULES)
    low, high = HOST_LIMITS
    return f"""
), judged AS (
  SELECT *, {" OR ".join(f"({RULES[r]})" for r in BASE_RULES)} AS base_failed, {each(lambda r: f"({RULES[r]})::INT AS {r}")} FROM counted
), hosts AS (
  SELECT source, count(*)::DOUBLE AS n, {each(lambda r: f"sum({r})::DOUBLE AS {r}_f")} FROM judged GROUP BY source
), total AS (
  SELECT sum(n) AS all_n, count(*) AS h, {each(lambda r: f"sum({r}_f) / sum(n) AS {r}_m")} FROM hosts
), spread AS (
  SELECT {each(lambda r: f"any_value({r}_m) AS {r}_m, sum(n * (({r}_f / n) - {r}_m) * (({r}_f / n) - {r}_m)) / sum(n) - any_value({r}_m * (1 - {r}_m) * (h - 1) / all_n) AS {r}_v")} FROM hosts, total
), prior AS (
  SELECT {each(lambda r: f"{r}_m, CASE WHEN {r}_v <= 0 THEN 1e6 ELSE least(greatest({r}_m * (1 - {r}_m) / {r}_v - 1, 1.0), 1e6) END AS {r}_s")} FROM spread
), limits AS (
  SELECT *, {each(lambda r: f"least(greatest({r}_m + {DEVIATIONS} * sqrt({r}_m * (1 - {r}_m) / ({r}_s + 1)), {low}), {high}) AS {r}_l")} FROM prior
), verdicts AS (
  SELECT source, concat_ws(',', {each(lambda r: f"CASE WHEN ({r}_f + {r}_m * {r}_s) / (n + {r}_s) > {r}_l THEN '{r}' END")}) AS host_rules FROM hosts, limits
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, host_rules <> '' AS host_failed, host_rules,
       NOT base_failed AND host_rules = '' AS kept
FROM judged JOIN verdicts ON judged.source IS NOT DISTINCT FROM verdicts.source
"""


_COUNTS_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), starts AS (
  SELECT doc_id, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM d
), grams AS (
  SELECT s.doc_id, s.i, array_to_string(d.ws[s.i : s.i + 4], ' ') AS gram FROM starts s JOIN d USING (doc_id)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM grams) WHERE c > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, d.source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN repeated r USING (doc_id)
"""

OP8_SQL = _COUNTS_SQL + _verdicts_sql()
