"""A prefix trie over conversations.

A conversation is the sequence of its turns; equal sequences are counted together first, so copies weigh one row.
Sequences are dealt by the digest of their first turn, and each bucket builds its tries as dictionaries of pointers.
Where sequences of one first turn are too many for a bucket, they are dealt anew by the next turn at which they part, as often as
needed; the few nodes above such a place (the spine) are summed from the tries below them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small_side, stored, table, unused

#: Turns of a bucket on average, at most; twice the average makes a group of one prefix too large.
BUCKET_TURNS = 20_000
#: Members of a sequence whose ids are gathered in one row; more are hashed as a stream of chunks of this size.
MANY_IDS = 4096
#: Rows of group keys that are broadcast at most, after a count.
KEYS = 1_000_000

COUNTS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
NODES = "node string, parent string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_TOPS = NODES + ", d array<string>, b array<long>"
_NO_IDS = hashlib.sha256(b"").hexdigest()


def prefix_key(digests: Column, turns: Column) -> Column:
    """The digest of the first ``turns`` turns."""
    return F.md5(F.array_join(F.slice(digests, F.lit(1), turns.cast("int")), ""))


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id and ``x``: what sorts a turn in its conversation, its digest ``d`` and the bytes ``b`` of its text.  Null role or text: empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    rows = conversations.where(F.col("conv_id").isNotNull())
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("d"), F.octet_length(text).cast("long").alias("b")).alias("x"))


def plain_paths(conversations: DataFrame) -> DataFrame:
    """Each conversation as it is: conv_id, ``d`` (digests of its turns in order) and ``b`` (bytes of their texts)."""
    own = turn_rows(conversations).groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return own.select("conv_id", F.col("x.d").alias("d"), F.col("x.b").alias("b"))


def rebuilt_paths(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % family; h is crc32 of its id as text, modulo ``heads``.

    One shuffle: conversations of a family meet, ``family`` ids of one sign at most.
    """
    rows = turn_rows(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("x")).alias("own"))
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.col("own")), ignorenulls=True).over(W.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    with_head = own.withColumn("head", F.coalesce(first, F.slice("own", 1, 0)))
    turns = F.concat(F.slice("head", F.lit(1), h), F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0))))
    return with_head.select("conv_id", turns.alias("x")).select("conv_id", F.col("x.d").alias("d"), F.col("x.b").alias("b"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) to (key, first, ids): the ids of a key as text, a bounded number a row."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows, start = [], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start] or i - start == MANY_IDS:
                rows.append((keys[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        k, f, t = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(f, pa.int64()), pa.array(t, pa.string())], names=["key", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (key, first) to the digest of each key's ids, holding one chunk at a time."""
    key, state = None, hashlib.sha256()
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends"])
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    yield row()
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if key is not None:
        yield row()


def member_digests(ids: DataFrame) -> DataFrame:
    """(key, n, conv_id) to (key, ends): SHA-256 of the ids of a key, ascending and comma-joined; n is the key's number of ids.

    Ids of large keys are dealt by ranges of (key, id), so no task sorts a key alone; the last step streams their joined chunks.
    """
    joined = F.sha2(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").cast("binary"), 256)
    few = ids.where(F.col("n") <= MANY_IDS).groupBy("key").agg(joined.alias("ends"))
    many = ids.where(F.col("n") > MANY_IDS).select("key", "conv_id")
    chunks = many.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_chunks, "key string, first long, ids string")
    return few.unionByName(chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key string, ends string"))


def distinct_sequences(paths: DataFrame) -> DataFrame:
    """(d, b, n, conv_id, ends): each distinct sequence, its number of members, the smallest, and the digest of their ids."""
    paths = stored(paths)
    seqs = stored(paths.groupBy("d", "b").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).withColumn("key", prefix_key(F.col("d"), F.size("d"))))
    shared = small_side(seqs.where("n > 1").select("key", "n"), KEYS)
    ids = paths.select(prefix_key(F.col("d"), F.size("d")).alias("key"), "conv_id").join(shared, "key")
    alone = seqs.where("n = 1").withColumn("ends", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    return alone.unionByName(seqs.where("n > 1").join(member_digests(ids), "key")).drop("key")


def dealt_groups(seqs: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """Sequences with the length ``k`` of the prefix that deals them and its ``key``, and sequences that end above their group.

    Groups start with k = 1.  A group of more than ``bound`` turns goes on at the first turn at which its sequences part, so chains of turns
    that all share cost one round.
    """
    size, k = F.size("d"), F.col("k")
    pending = seqs.where(size > 0).withColumn("k", F.lit(1)).withColumn("key", prefix_key(F.col("d"), F.lit(1)))
    settled, ended = [], [seqs.where(size == 0)]
    while True:
        sizes = pending.groupBy("key").agg(F.sum(size - k + 1).alias("turns"), F.count("*").alias("rows"))
        big = stored(sizes.where((F.col("turns") > bound) & (F.col("rows") > 1)).select("key"))
        if big.isEmpty():
            break
        big = small_side(big, KEYS)
        settled.append(pending.join(big, "key", "left_anti"))
        ends = pending.join(big, "key").groupBy("key").agg(F.min("d").alias("low"), F.max("d").alias("high"))
        least = F.least(F.size("low"), F.size("high"))
        parts = F.array_position(F.zip_with(F.slice("low", F.lit(1), least), F.slice("high", F.lit(1), least), lambda x, y: x == y), False)
        shared = ends.select("key", F.when(parts > 0, parts - 1).otherwise(least).cast("int").alias("shared"))
        moved = stored(pending.join(small_side(shared, KEYS), "key").withColumn("k", F.col("shared") + 1).withColumn("key", prefix_key(F.col("d"), F.col("k"))).drop("shared"))
        ended.append(moved.where(size < k).select(*seqs.columns))
        pending = moved.where(size >= k)
    return reduce(DataFrame.unionByName, [*settled, pending]), reduce(DataFrame.unionByName, ended)


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    """The tries of a bucket: a node is a place in lists, its children a dictionary from a turn's digest to a place."""
    kids: list[dict[str, int]] = []
    parent, depth, size, least, members, ends, state, path = [], [], [], [], [], [], [], []
    tops: dict[str, int] = {}

    def node(above: int, level: int, digest: str, hashed, text_bytes: int) -> int:
        hashed.update(digest.encode())
        kids.append({})
        parent.append(above)
        depth.append(level)
        size.append(text_bytes)
        least.append(None)
        members.append(0)
        ends.append(_NO_IDS)
        state.append(hashed)
        path.append(None)
        return len(kids) - 1

    for d, b, n, conv_id, digest, k, key in zip(rows["d"], rows["b"], rows["n"], rows["conv_id"], rows["ends"], rows["k"], rows["key"], strict=True):
        at = tops.get(key)
        if at is None:
            at = tops[key] = node(-1, k, d[k - 1], hashlib.md5("".join(d[: k - 1]).encode()), int(b[k - 1]))
            path[at] = (list(d[:k]), list(b[:k]))
        level = k
        while True:
            members[at] += n
            least[at] = conv_id if least[at] is None else min(least[at], conv_id)
            if level == len(d):
                break
            below = kids[at].get(d[level])
            if below is None:
                below = kids[at][d[level]] = node(at, level + 1, d[level], state[at].copy(), int(b[level]))
            at, level = below, level + 1
        ends[at] = digest

    leaves, saved = [0] * len(kids), [(m - 1) * s for m, s in zip(members, size, strict=True)]
    for top in tops.values():  # postorder without recursion: a node is left after its last child
        stack = [(top, iter(kids[top].values()))]
        while stack:
            at, rest = stack[-1]
            below = next(rest, None)
            if below is not None:
                stack.append((below, iter(kids[below].values())))
                continue
            stack.pop()
            leaves[at] = leaves[at] or 1
            if parent[at] >= 0:
                leaves[parent[at]] += leaves[at]
                saved[parent[at]] += saved[at]
    keys = [s.hexdigest() for s in state]
    found = {
        "node": keys,
        "parent": [keys[p] if p >= 0 else hashlib.md5("".join(path[i][0][:-1]).encode()).hexdigest() for i, p in enumerate(parent)],
        "conv_id": least,
        "depth": depth,
        "parent_conv_id": pd.array([least[p] if p >= 0 else None for p in parent], dtype="Int64"),
        "n_convs": members,
        "n_children": [len(x) for x in kids],
        "n_leaves": leaves,
        "saved_tokens": saved,
        "ends_sha256": ends,
        "d": [p and p[0] for p in path],
        "b": [p and p[1] for p in path],
    }
    return pd.DataFrame(found)


def spine_nodes(tops: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes above all tops of tries, the root among them, from sums over the tops and over sequences that end there."""
    above = lambda last: F.explode(F.sequence(F.lit(0), last)).alias("depth")
    from_tops = tops.select(above(F.size("d") - 1), "d", "b", "conv_id", "n_convs", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
    from_ends = ended.select(above(F.size("d")), "d", "b", "conv_id", F.col("n").alias("n_convs"), F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"), F.when(F.col("depth") == F.size("d"), F.col("ends")).alias("ends"))
    j = F.col("depth")
    rows = from_tops.unionByName(from_ends).select(
        F.slice("d", F.lit(1), j).alias("path"),
        F.when(j < F.size("d"), F.try_element_at("d", j + 1)).alias("child"),
        F.when(j > 0, F.try_element_at("b", F.greatest(j, F.lit(1)))).otherwise(0).alias("bytes"),
        "conv_id", "n_convs", "n_leaves", "saved_tokens", "ends",
    )
    totals = [F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved_tokens")], F.max("ends").alias("ends")]
    per_child = rows.groupBy("path", "child").agg(*totals)
    nodes = stored(per_child.groupBy("path").agg(*totals, F.count("child").alias("n_children")).withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")))
    below = nodes.select(above(F.size("path")), "path", "own").groupBy(F.slice("path", F.lit(1), j).alias("path")).agg(F.sum("own").alias("below"))
    up = F.size("path") - 1
    return nodes.join(below, "path").select(
        prefix_key(F.col("path"), F.size("path")).alias("node"),
        F.when(up >= 0, prefix_key(F.col("path"), F.greatest(up, F.lit(0)))).alias("parent"),
        "conv_id",
        F.size("path").cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("below")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_NO_IDS)).alias("ends_sha256"),
    )


def trie(paths: DataFrame) -> DataFrame:
    """All nodes of the trie over ``paths`` (conv_id, d, b; one row a conversation), as in ``NODES``.

    ``node`` and ``parent`` are digests of prefixes.  A conversation without turns ends at the root; without any conversation there is no
    node.  The digests of one conversation's turns (about 40 bytes each) are one value, as a text is.
    """
    spark = paths.sparkSession
    seqs = stored(distinct_sequences(paths))
    turns = seqs.agg(F.sum(F.size("d"))).first()[0] or 0
    buckets = max(-(-turns // BUCKET_TURNS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups, ended = dealt_groups(seqs, 2 * -(-turns // buckets))
    built = stored(groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(_build, _TOPS))
    tops = built.where(F.col("d").isNotNull())
    spine = stored(spine_nodes(tops, ended))
    ids = small_side(spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")), KEYS)
    columns = [c.split()[0] for c in NODES.split(", ")]
    edge = tops.select(*columns).unionByName(spine).join(ids, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return built.where(F.col("d").isNull()).select(*columns).unionByName(edge.select(*columns))


def with_node(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and ``node``, the trie's node at which it ends."""
    name = unused(conversations, "node")
    return plain_paths(conversations).select("conv_id", prefix_key(F.col("d"), F.size("d")).alias(name))


def op11_prefix_trie(spark, sf_dir):
    """Nodes of the trie over all rebuilt conversations.

    Rows with a null conv_id belong to no conversation.  Turns of a conversation are ordered by turn (null first), then role and digest; repeated
    rows are turns of their own.  Other columns are not read; an empty table has no node.
    """
    nodes = trie(rebuilt_paths(table(spark, sf_dir, "conversations")))
    return nodes.select("conv_id", "depth", "parent_conv_id", *COUNTS, "ends_sha256")


OP11_SQL = """
WITH RECURSIVE own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), coalesce(c.turns[c.h + 1:], [])) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), prefixes AS (
  SELECT conv_id, 0 AS depth, NULL::VARCHAR AS parent, md5('') AS node, 0::BIGINT AS bytes, len(turns) AS size, turns FROM rebuilt
  UNION ALL
  SELECT conv_id, depth + 1, node, md5(node || octet_length(encode(turns[depth + 1].r)) || ':' || turns[depth + 1].r || turns[depth + 1].t), octet_length(encode(turns[depth + 1].t)), size, turns
  FROM prefixes WHERE depth < size
), nodes AS (
  SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY node
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.parent = n.node) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.node = n.parent
), above AS (
  SELECT node AS top, parent, n_children = 0 AS leaf, (n_convs - 1) * bytes AS own FROM linked
  UNION ALL
  SELECT n.node, n.parent, a.leaf, a.own FROM above a JOIN nodes n ON n.node = a.parent
), sums AS (
  SELECT top, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum(own) AS saved_tokens FROM above GROUP BY top
)
SELECT n.conv_id, n.depth::BIGINT AS depth, n.parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM linked n JOIN sums s ON s.top = n.node
"""
