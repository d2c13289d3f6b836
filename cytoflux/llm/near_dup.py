"""Near-duplicates by DartMinHash signatures and banded joining.

A document is the weighted set of its shingles of five words; the weight is how often a shingle
occurs, so the n-th occurrence of a shingle owns the strip [n - 1, n) of weights.  Hashed darts fall on each
strip and rank, as a fixed random pattern with one dart per unit area; a document takes the darts on its
strips up to a rank that gives it about K ln K + 2 K of them, each dart is sent to one of K coordinates by
its hash, and the earliest dart of a coordinate is the signature there.  Two documents agree in a coordinate with
a probability equal to their weighted Jaccard similarity.

Documents that agree in all rows of a band share a bucket.  First each member is compared with its bucket's centre, the
member with the most bucket-mates over all bands, which joins most of a large group.  Then members that are still outside
the centre's component are compared with all members of their buckets, a block of these with a block of those, so no link between
documents that share a bucket is lost and a group that is one component costs no pairs.  Candidates are checked on whole signatures, then
by the weighted Jaccard similarity of their whole shingle sets, in which a shingle is a hash of 55 bits.  Links are joined to components.
A bucket's rows are dealt out by a salt wherever they meet a table of buckets.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import group_starts, kept, per_salt, small_side, stored, table, unused, whole_groups, with_columns_from
from .components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 6
K = BANDS * ROWS
#: A candidate goes on to the exact check from this share of equal coordinates: 6 deviations below the threshold.
LIKELY = 0.6
#: Texts that are hashed together (at most 512: their number takes 9 bits of a key), rows of a block of a bucket, parts of a bucket in joins.
BLOCK, MEMBERS, SALTS = 512, 128, 64
#: Rows of one or two numbers that are broadcast at most, about 50 MB and 100 MB; beyond, texts are shuffled.
ONE_KEY, TWO_KEYS = 2_000_000, 1_000_000
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 200_000:
            self[word] = value
        return value




def strips(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbered strips of up to 512 texts: the text of each, its hash, and the number per text.

    A text of one to four words has one shingle, all its words; a text without a word has none.
    """
    words = [(t or "").lower().encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.fromiter(map(kept("words", _Words).__getitem__, [w for ws in words for w in ws]), _U, int(sizes.sum()))
    row = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    h, at = np.zeros(0, _U), np.zeros(0, np.int64)
    if len(flat) >= SHINGLE:
        n = len(flat) - SHINGLE + 1
        h = np.full(n, SHINGLE, _U)
        for k in range(SHINGLE):
            h = mix(h + flat[k : n + k])
        inside = row[:n] == row[SHINGLE - 1 :]
        h, at = h[inside], row[:n][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        first = np.cumsum(sizes) - sizes
        own = []
        for i in short:
            x = np.full(1, sizes[i], _U)
            for w in flat[first[i] : first[i] + sizes[i]]:
                x = mix(x + w)
            own.append(x)
        h, at = np.concatenate([h, *own]), np.concatenate([at, short])
    key = np.sort((at.astype(_U) << _U(55)) | (h >> _U(9)))
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    place = np.arange(len(key))
    nth = place - np.maximum.accumulate(np.where(first, place, 0)) if len(key) else place
    row = (key >> _U(55)).astype(np.int64)
    strip = mix((key & _U((1 << 55) - 1)) + mix(nth.astype(_U) + _U(0x51ED270B)))
    return row, strip, np.bincount(row, minlength=len(texts))


_CDF: dict[float, np.ndarray] = {}


def _poisson(mean: float, u: np.ndarray) -> np.ndarray:
    if mean not in _CDF:
        k = np.arange(int(mean + 12 * mean**0.5 + 24))
        log = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        _CDF[mean] = np.cumsum(np.exp(k * np.log(mean) - mean - log))
    return np.searchsorted(_CDF[mean], u, side="right")


def dart_signatures(row: np.ndarray, strip: np.ndarray, sizes: np.ndarray, k: int = K) -> np.ndarray:
    """The earliest rank per coordinate, a row per text; infinite where a text has no strip."""
    found = np.full(len(sizes) * k, np.inf)
    rank_limit = (k * np.log(k) + 2 * k) / np.maximum(sizes, 1)
    open_ = sizes > 0
    while open_.any():
        low, high = 0.0, 0.25
        while True:
            active = open_ & (rank_limit > low)
            if not active.any():
                break
            chosen = active[row]
            s, r = strip[chosen], row[chosen]
            level = _U(int(high * 4) * 0x9E3779B97F4A7C15 % (1 << 64))
            n = _poisson(high - low, (mix(s ^ level) >> _U(11)) * 2.0**-53)
            of = np.repeat(np.arange(len(s)), n)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            h = mix(mix(s[of] + level) + nth.astype(_U) * _U(0xD6E8FEB86659FD93))
            rank = low + (high - low) * ((h >> _U(11)) * 2.0**-53)
            early = rank < rank_limit[r[of]]
            coordinate = ((mix(h[early] ^ _U(0x2545F4914F6CDD1D)) >> _U(32)) * _U(k)) >> _U(32)
            np.minimum.at(found, r[of][early] * k + coordinate.astype(np.int64), rank[early])
            low, high = high, 2 * high
        open_ &= np.isinf(found.reshape(-1, k)).any(axis=1)  # a coordinate without a dart: look farther
        rank_limit = np.where(open_, 2 * rank_limit, rank_limit)
    return found.reshape(-1, k)


def _signed(bands: int, rows: int):
    def make():
        def compute(column: pa.Array):
            texts = column.to_pylist()
            lists, shorts = [], []
            for i in range(0, len(texts), BLOCK):
                row, strip, sizes = strips(texts[i : i + BLOCK])
                bits = dart_signatures(row, strip, sizes, bands * rows).view(_U)
                split = bits.reshape(len(sizes), bands, rows)
                h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U)), split.shape[:2])
                for k in range(rows):
                    h = mix(h ^ split[:, :, k])
                small = (mix(bits) & _U(255)).astype(np.uint8)
                h = h.astype(np.int64)
                lists += [h[j].tolist() if sizes[j] else [] for j in range(len(sizes))]
                shorts += [small[j].tobytes() if sizes[j] else None for j in range(len(sizes))]
            return lists, shorts

        return compute

    return make


def _shingle_sets():
    def compute(column: pa.Array):
        texts, out = column.to_pylist(), []
        for i in range(0, len(texts), BLOCK):
            row, strip, sizes = strips(texts[i : i + BLOCK])
            cut = np.split(strip.view(np.int64), np.cumsum(sizes)[:-1])
            out += [x.tolist() for x in cut]
        return [out]

    return compute


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id``, ``copy_key`` (the same for equal texts, null for null), ``bands`` and ``signature``."""
    keyed = docs.select("doc_id", copy_key().alias("copy_key"), "text")
    return with_columns_from(keyed, ["text"], {"bands": "array<long>", "signature": "binary"}, _signed(bands, rows)).drop("text")


def copy_key() -> Column:
    return F.md5(F.col("text").cast("binary"))


def node_of(least_id: Column, key: Column) -> Column:
    """A distinct text as a node: its least id first, so the least node of a component has its least id; then its hash, which tells texts of one id apart."""
    return F.struct(least_id.alias("id"), F.xxhash64(key).alias("k"))


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree in the share LIKELY of coordinates."""
    a = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def check(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
            keep = pa.array((left == right).mean(axis=1) >= LIKELY) if batch.num_rows else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose shingles have the similarity."""
    a, b = sets.select(F.col("node").alias("a"), F.col("s").alias("s1")), sets.select(F.col("node").alias("b"), F.col("s").alias("s2"))
    common = F.size(F.array_intersect("s1", "s2"))
    return stored(pairs.join(a, "a").join(b, "b").where(common >= threshold * (F.size("s1") + F.size("s2") - common)).select("a", "b"))


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))


def _with_centres(members: DataFrame) -> DataFrame:
    """Members with their bucket's centre, the one with the most bucket-mates, and its component ``other``."""
    best = stored(per_salt(members, ["bucket"], F.max(F.struct("mates", "node", "component")).alias("best"), salts=SALTS))
    return members.join(best.select("bucket", "salt", F.col("best.node").alias("centre"), F.col("best.component").alias("other")), ["bucket", "salt"])


def _likely_pairs(a: dict, b: dict, bucket: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block of queries and of a block of members, in other components, whose signatures agree in the share LIKELY; a pair counts in its first common bucket."""
    band, found = int(np.argmax(a["bands"][0] == bucket)), []
    for q in range(len(a["at"])):
        near = (b["signature"] == a["signature"][q]).mean(axis=1) >= LIKELY
        near &= (b["component"] != a["component"][q]) & ~(b["bands"][:, :band] == a["bands"][q, :band]).any(axis=1)
        hits = np.flatnonzero(near)
        found.append(np.stack([np.full(len(hits), q), hits]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64),) * 2


def _linked(a: list[np.ndarray], b: list[np.ndarray], pairs: tuple[np.ndarray, np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """The likely pairs whose shingles have the similarity."""
    sizes, links = np.array([len(s) for s in b]), []
    for q in np.unique(pairs[0]):
        hits, mine = pairs[1][pairs[0] == q], np.sort(a[q])
        flat = np.concatenate([b[k] for k in hits])
        place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
        common = np.bincount(np.repeat(np.arange(len(hits)), sizes[hits]), weights=mine[place] == flat, minlength=len(hits))
        found = common >= threshold * (sizes[hits] + len(mine) - common)
        links += [(int(q), int(k)) for k in hits[found]]
    return links


PAIR_OF_BLOCKS = ["bucket", "block", "queries"]


def _sides_of_blocks(batches):
    """Of each pair of blocks: the table, its bucket, and its queries and members as numbers and arrays."""
    for t in whole_groups(batches, PAIR_OF_BLOCKS):
        number = {c: t.column(c).to_numpy() for c in ("node", "component", "query", *PAIR_OF_BLOCKS)}
        raw, lists, sides = t.column("signature").to_pylist(), t.column("bands"), []
        for start, stop in itertools.pairwise(group_starts(t, PAIR_OF_BLOCKS)):
            both = []
            for side in (True, False):
                at = start + np.flatnonzero(number["query"][start:stop].astype(bool) == side)
                signature = np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(len(at), -1)
                both.append({"at": at, "component": number["component"][at], "signature": signature, "bands": np.array(lists.take(pa.array(at)).to_pylist(), dtype=np.int64).reshape(len(at), -1)})
            if all(len(x["at"]) for x in both):
                sides.append((int(number["bucket"][start]), *both))
        yield t, number, sides


def _likely_rows(batches):
    """Rows of pairs of blocks that have a likely partner there."""
    for t, _, sides in _sides_of_blocks(batches):
        wanted = np.zeros(t.num_rows, bool)
        for bucket, a, b in sides:
            q, k = _likely_pairs(a, b, bucket)
            wanted[a["at"][q]] = wanted[b["at"][k]] = True
        yield from t.drop_columns(["bands", "signature"]).filter(pa.array(wanted)).combine_chunks().to_batches()


def _block_links(threshold: float):
    def run(batches):
        for t, number, sides in _sides_of_blocks(batches):
            sets, out = t.column("s"), []
            own = lambda side, sets=sets: [np.asarray(sets[i].values) for i in side["at"].tolist()]
            for bucket, a, b in sides:
                pairs = _likely_pairs(a, b, bucket)
                if len(pairs[0]):
                    out += [(a["at"][i], b["at"][j]) for i, j in _linked(own(a), own(b), pairs, threshold)]
            i, j = np.array(out, dtype=np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(number["node"][x]) for x in (i, j)], names=["a", "b"])

    return run


def _links_across(members: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """All links within buckets between members of different components.

    In a bucket, members outside the centre's component are queries against all members.  Members and queries are each dealt out to blocks of
    about MEMBERS rows, and each block of queries meets each block of members in a group of its own, so a task holds two blocks
    whatever the size of a bucket; members of the centre's component are never compared with each other.  Signatures go to all pairs of blocks; shingles follow only for texts that
    have a likely partner there, so texts that merely share a passage are not copied.
    """
    placed = _with_centres(members).withColumn("query", F.col("component") != F.col("other"))
    whole = per_salt(placed, ["bucket"], F.count_if("query").alias("asked"), salts=SALTS).where("asked > 0")
    blocks = lambda c: F.ceil(F.col(c) / MEMBERS).cast("int")
    whole = stored(whole.select("bucket", "salt", blocks("n").alias("blocks"), blocks("asked").alias("query_blocks")))
    placed = stored(placed.join(whole, ["bucket", "salt"]).select("node", "component", "bucket", "query", "blocks", "query_blocks"))
    signed = nodes.select("node", "bands", "signature")
    full = placed.join(signed, "node")
    own = lambda c, seed: F.pmod(F.xxhash64("node", "bucket", F.lit(seed)), F.col(c)).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    as_member = full.withColumn("query", F.lit(False)).withColumn("block", own("blocks", 1)).withColumn("queries", all_of("query_blocks"))
    as_query = full.where("query").withColumn("queries", own("query_blocks", 2)).withColumn("block", all_of("blocks"))
    names = ["node", "component", "query", *PAIR_OF_BLOCKS]
    dealt = lambda rows: rows.repartition(*PAIR_OF_BLOCKS).sortWithinPartitions(*PAIR_OF_BLOCKS)
    rows = as_member.unionByName(as_query).select(*names, "bands", "signature")
    likely = stored(dealt(rows).mapInArrow(_likely_rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (rows.schema[c] for c in names))))
    rows = likely.join(signed, "node").join(sets, "node").select(*names, "bands", "signature", "s")
    return stored(dealt(rows).mapInArrow(_block_links(threshold), "a long, b long"))


def link(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Members (``doc_id``, ``k``, ``text_node``; no node for a null id or text) and links (``a``, ``b``) between nodes.

    A node is a group of equal texts, see ``node_of``; until links are known, a number stands for it.
    """
    signed = stored(signatures(docs, bands, rows))
    first = signed.where("copy_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("copy_key")
    nodes = first.agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    nodes = stored(nodes.select("copy_key", node_of(F.col("least"), F.col("copy_key")).alias("text_node"), "bands", "signature").withColumn("node", F.monotonically_increasing_id()))
    # Rows without id or text are nobody's member, and no row of a join: they may be many.
    outside = F.col("copy_key").isNull() | F.col("doc_id").isNull()
    kind = nodes.schema["text_node"].dataType
    members = signed.where(~outside).select("doc_id", "copy_key").join(nodes.select("copy_key", "text_node"), "copy_key").select("doc_id", F.xxhash64("copy_key").alias("k"), "text_node")
    members = members.unionByName(signed.where(outside).select("doc_id", F.xxhash64("copy_key").alias("k"), F.lit(None).cast(kind).alias("text_node")))

    each = _salted(nodes.select("node", F.explode("bands").alias("bucket")))
    buckets = stored(each.join(stored(per_salt(each, ["bucket"], salts=SALTS)), ["bucket", "salt"]))
    mates = stored(buckets.groupBy("node").agg(F.sum("n").alias("mates")))
    buckets = stored(buckets.join(mates, "node").select("node", "bucket", "salt", "mates", F.col("node").alias("component")))
    nodes = stored(nodes.join(mates, "node").select("node", "text_node", "bands", "signature"))
    # Only texts with a bucket-mate are moved, once; afterwards their shingles are.
    wanted = nodes.select("node", F.col("text_node.id").alias("id"), F.col("text_node.k").alias("k"))
    some = stored(wanted.select(F.xxhash64("id", "k").alias("h")))
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64(copy_key()).alias("k"), "text").withColumn("h", F.xxhash64("id", "k"))
    texts = texts.join(small_side(some, ONE_KEY), "h", "left_semi").join(wanted, ["id", "k"]).groupBy("node").agg(F.first("text").alias("text"))
    sets = stored(with_columns_from(texts, ["text"], {"s": "array<long>"}, _shingle_sets).select("node", "s"))

    # Most members of a large group are linked by one comparison with a centre.
    central = _with_centres(buckets).where("component <> other").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    links = _verified(_alike(central, nodes), sets, threshold)
    found = stored(components(links))
    buckets = stored(buckets.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    # What is still apart is compared with all of its buckets.
    links = links.union(_links_across(buckets, nodes, sets, threshold))
    for end in ("a", "b"):
        links = links.join(nodes.select(F.col("node").alias(end), F.col("text_node").alias(f"{end}_text")), end)
    return members, links.select(F.col("a_text").alias("a"), F.col("b_text").alias("b"))


def labelled(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``k`` (the text's hash), ``component_id`` and ``kept``; see ``near_duplicates``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members, links = link(docs, threshold)
    found = stored(components(links)).withColumnRenamed("node", "own")
    inside, outside = members.where("text_node IS NOT NULL"), members.where("text_node IS NULL").withColumn("component", F.col("text_node"))
    label = inside.join(found, inside["text_node"] == found["own"], "left").select("doc_id", "k", "text_node", F.coalesce("component", "text_node").alias("component")).unionByName(outside)
    kept_row = (F.col("text_node") == F.col("component")) & (F.col("doc_id") == F.col("component.id"))
    k = F.when(F.col("text_node").isNotNull(), F.col("k"))
    return stored(label.select("doc_id", k.alias("k"), F.coalesce("component.id", "doc_id").alias("component_id"), F.coalesce(kept_row, F.lit(True)).alias("kept")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``component_id`` (the least id of its group), ``kept``.

    Equal texts are one group; texts without a word have no shingle and join only their equals.  A null text or a null id
    links with nothing and is kept.  Rows that share an id but differ in text are documents of their own, so they may be in different groups that have the same
    ``component_id``; of a group with several texts under its least id the text with the least hash is kept.  Rows that repeat
    id and text get the same answer.  The result does not depend on the order of rows.  Other columns are not read.
    """
    return labelled(docs, threshold).select("doc_id", "component_id", "kept")


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: one row of each group; rows with a null id or text stay too.  All columns.

    Rows to drop are fewer than rows to keep, so texts are joined with ids and hashes to drop; only rows that repeat id and text are ranked, and
    the first by all columns that can be ordered stays.
    """
    label = labelled(docs, threshold).where("k IS NOT NULL")
    key, row = unused(docs, "text_hash"), unused(docs, "row")
    label = label.withColumnRenamed("k", key)
    dropped = stored(label.where("NOT kept").select("doc_id", key).distinct())
    repeated = stored(label.where("kept").groupBy("doc_id", key).agg(F.count("*").alias("n")).where("n > 1").select("doc_id", key))
    left = docs.withColumn(key, F.xxhash64(copy_key())).join(small_side(dropped, TWO_KEYS), ["doc_id", key], "left_anti")
    repeated = small_side(repeated, TWO_KEYS)
    order = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in ("doc_id", "text") and not f.dataType.typeName().startswith(("map", "variant"))]
    ranked = left.join(repeated, ["doc_id", key], "left_semi").withColumn(row, F.row_number().over(W.partitionBy("doc_id", key).orderBy(*(order or [F.lit(1)]))))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return left.join(repeated, ["doc_id", key], "left_anti").select(*names).unionByName(ranked.where(F.col(row) == 1).select(*names))


def op5_dart_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
