"""Jaccard join of shingle sets with signature trees (operator 5).

Two texts link when the Jaccard similarity of their sets of shingles is at least a percentage.
Equal sets are one class.  Classes that could link are brought together by offers that lose no
link.  A size class holds the sizes from some number up to the largest that can link with it,
so a set offers in its own class and, if it can link with larger sets, in the next.  In a
class, every set is cut by hash ranges into more parts than two linked sets can differ in, so
some parts are equal:

* a set knows how many of its parts may differ from a partner's.  If no more than the rest of
  its parts hold fewer than ``k`` shingles, an equal part with ``k`` is left over, and it offers
  only such parts, for the largest such ``k``.  Of two linked sets, the one with the larger ``k``
  has an equal part of that many shingles, which the other offers too;
* sets that differ in up to ``PAIRED`` parts offer pairs of parts instead;
* sets with too many empty parts for either offer also their least shingles, one more than a
  partner can lack; so do all sets at less than ``PARTED`` percent.  Empty parts are never offered.

Classes that share an offer are candidates of each other.  Candidates are gathered by
components.  Within one, a tree over the classes holds OR-combined token bitmaps, size ranges
and the largest number of shingles that share a bit; a dual traversal prunes pairs of nodes by
the largest overlap they could have, and pairs of nodes already known to be connected.  What is
left is verified exactly.

Joins with offers, texts and results always shuffle both sides (an input small enough for a
broadcast is no reason for another plan).  Scale: offers are a fixed share of the shingles and
shuffle once, as two longs each, a set's once a task however many copies the task has; texts
travel once.  A candidate component of more than ``BLOCK`` shingles is dealt into blocks and
every pair of blocks is a task of its own, so memory is bounded; links are never expanded into
pairs, only enough of them to connect.  Shingles and sets are identified by 64-bit hashes.

Defined cases: null, empty and blank texts have no shingles and link with nothing (their
component is their own id); a text of fewer words than a shingle is one shingle; rows of one
id count as one document; a row without an id links with nothing and has no component; an
empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches, small_batches, table, written
from footfall.llm.components import components
from footfall.llm.shingles import mix, set_hash, shingle_set

PERCENT = 90
SIZE = 3
BLOCK = 3_000_000
LEAF = 32
FEW = 3  # so many sets need no tree
PAIRED = 8  # up to so many differences, pairs of parts are offered
PARTED = 75  # below this percentage, parts would be too small
DIFFER = 0.7  # share of the parts in which two sets that just link differ
_MAX_SIZE = 1 << 40
_ODD, _LEAST = np.uint64(0x9E3779B97F4A7C15), 0xD1B54A32D192ED03


@lru_cache
def size_bounds(percent: int) -> list[int]:
    """Smallest sizes of the size classes: the largest size of a class can just link with the smallest."""
    out = [1]
    while out[-1] < _MAX_SIZE:
        out.append(100 * out[-1] // percent + 1)
    return out


def _differ(percent: int, a: int, b: int) -> int:
    """Most shingles in which linked sets of these sizes differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def _parts(members: np.ndarray, n_parts: int, tag: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and hashes of the shingles in each range of hashes."""
    where = ((members >> np.uint64(32)) * np.uint64(n_parts) >> np.uint64(32)).astype(np.int64)
    counts = np.bincount(where, minlength=n_parts)
    full = np.flatnonzero(counts)
    sums = np.zeros(n_parts, np.uint64)
    sums[full] = np.add.reduceat(mix(members + np.uint64(1)), (np.cumsum(counts) - counts)[full])
    return counts, mix(sums + np.arange(n_parts, dtype=np.uint64) * _ODD + tag)


def offers(members: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of which a sorted set shares one with every set it could link to, as signed integers."""
    if percent >= 100:  # every size is a class of its own
        return np.array([set_hash(members)])
    n, found, bounds = len(members), [], size_bounds(percent)
    reach, own = 100 * n // percent, int(np.searchsorted(bounds, n, "right")) - 1
    for k in (own, own + 1):
        if bounds[k] > reach:
            break
        top, tag = bounds[k + 1] - 1, np.uint64(k + 1)
        most = _differ(percent, top, top)
        if most <= PAIRED:
            counts, hashes = _parts(members, most + 2, tag)
            i, j = np.triu_indices(most + 2, 1)
            some = (counts[i] > 0) | (counts[j] > 0)
            found.append(mix(hashes[i[some]] ^ mix(hashes[j[some]] + tag)))
            least = (counts == 0).sum() > 1
        elif percent >= PARTED:
            n_parts = max(most + 2, int(most / DIFFER) + 1)
            counts, hashes = _parts(members, n_parts, tag)
            spare = n_parts - _differ(percent, n, min(top, reach)) - 1
            fewer = np.cumsum(np.bincount(counts))  # parts of up to so many shingles
            size = int((fewer <= spare).sum())
            found.append(hashes[counts >= max(1, size)])
            least = size == 0
        else:
            least = True
        if least:
            found.append(mix(members[:n - -(-percent * n // 100) + 1] ^ np.uint64((k + 1) * _LEAST % 2**64)))
    return np.unique(np.concatenate(found)).view(np.int64)


def sketch(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``h`` (hash of the set, null if empty), ``offers`` (null if an earlier
    row of the task has them)."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("n_shingles", T.LongType()),
                           T.StructField("h", T.LongType()), T.StructField("offers", T.ArrayType(T.LongType()))])

    def run(batches):
        seen = set()
        for b in batches:
            n, h, o = [], [], []
            for t, named in zip(b.column(text), b.column(key).is_valid().to_pylist()):
                s = shingle_set(t.as_py(), size)
                n.append(len(s))
                h.append(set_hash(s) if len(s) else None)
                fresh = len(s) and named and h[-1] not in seen
                o.append(offers(s, percent) if fresh else None)
                if fresh:
                    seen.add(h[-1])
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(n, pa.int64()), pa.array(h, pa.int64()),
                                              pa.array(o, pa.list_(pa.int64()))], schema.names)

    return map_batches(docs.select(key, text), run, schema)


class SignatureTree:
    """A binary tree over sets, ordered by size and bitmap; links found join their components."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.root = list(range(len(sets)))
        sizes = np.array([len(s) for s in sets])
        bits = int(min(65536, max(1024, 1 << int(4 * sizes.max()).bit_length())))
        maps = np.zeros((len(sets), bits // 8), np.uint8)
        for i, s in enumerate(sets):
            at = (s >> np.uint64(20)).astype(np.int64) % bits
            flags = np.zeros(bits, bool)
            flags[at] = True
            maps[i] = np.packbits(flags)
        maps = maps.view(np.uint64)
        self.order = np.lexsort((maps[:, -1], maps[:, 0], sizes)).tolist()
        self.maps, self.sizes = maps[self.order], sizes[self.order]
        self.shared = self.sizes - np.bitwise_count(self.maps).sum(1, dtype=np.int64)
        # node: (first, last, OR bitmap, smallest, largest, most shared, left, right)
        self.nodes: list[tuple] = []
        self.same: list[bool] = []
        self.top = self._build()

    def _build(self) -> int:
        level = []
        for a in range(0, len(self.order), LEAF):
            b = min(a + LEAF, len(self.order))
            level.append(self._node(a, b, np.bitwise_or.reduce(self.maps[a:b]), self.shared[a:b].max(), -1, -1))
        while len(level) > 1:
            up = []
            for x, y in zip(level[::2], level[1::2]):
                p, q = self.nodes[x], self.nodes[y]
                up.append(self._node(p[0], q[1], p[2] | q[2], max(p[5], q[5]), x, y))
            level = up + level[len(level) // 2 * 2:]
        return level[0]

    def _node(self, a, b, bitmap, shared, left, right) -> int:
        self.nodes.append((a, b, bitmap, int(self.sizes[a]), int(self.sizes[b - 1]), int(shared), left, right))
        self.same.append(False)
        return len(self.nodes) - 1

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def _one(self, x: int) -> bool:
        """Whether all sets below a node are connected; once true, it stays so."""
        if not self.same[x]:
            a, b, *_, left, right = self.nodes[x]
            if left >= 0:
                self.same[x] = self._one(left) and self._one(right) and (
                    self.find(self.order[a]) == self.find(self.order[b - 1]))
            else:
                first = self.find(self.order[a])
                self.same[x] = all(self.find(i) == first for i in self.order[a:b])
        return self.same[x]

    def _apart(self, p, q) -> bool:
        """Whether no set below one node can link with one below the other."""
        low, high = min(p[4], q[4]), max(p[3], q[3])
        if 100 * low < self.percent * high:
            return True
        most = int(np.bitwise_count(p[2] & q[2]).sum()) + min(p[5], q[5])
        return (100 + self.percent) * most < self.percent * (p[3] + q[3])

    def join(self, crossing=None) -> list[tuple[int, int]]:
        """Links that connect what is connected; ``crossing``: side of each set, if only links
        between two sides are wanted."""
        found, stack = [], [(self.top, self.top)]
        nodes = self.nodes
        while stack:
            x, y = stack.pop()
            p, q = nodes[x], nodes[y]
            if x == y:
                if p[6] < 0:
                    self._leaves(p, q, found, crossing)
                else:
                    stack += [(p[6], p[7]), (p[7], p[7]), (p[6], p[6])]
                continue
            if self._apart(p, q) or self._one(x) and self._one(y) and self.find(self.order[p[0]]) == self.find(self.order[q[0]]):
                continue
            if p[6] < 0 and q[6] < 0:
                self._leaves(p, q, found, crossing)
            elif q[6] < 0 or p[6] >= 0 and p[1] - p[0] >= q[1] - q[0]:
                stack += [(p[7], y), (p[6], y)]
            else:
                stack += [(x, q[7]), (x, q[6])]
        return found

    def _leaves(self, p, q, found, crossing):
        most = np.bitwise_count(self.maps[p[0]:p[1], None, :] & self.maps[None, q[0]:q[1], :]).sum(2, dtype=np.int64)
        most += np.minimum(self.shared[p[0]:p[1], None], self.shared[None, q[0]:q[1]])
        sizes = self.sizes[p[0]:p[1], None] + self.sizes[None, q[0]:q[1]]
        close = (100 + self.percent) * most >= self.percent * sizes
        if p is q:
            close = np.triu(close, 1)
        for i, j in zip(*np.nonzero(close)):
            a, b = self.order[p[0] + i], self.order[q[0] + j]
            if crossing is not None and crossing[a] == crossing[b]:
                continue
            r, s = self.find(a), self.find(b)
            if r != s and self._linked(self.sets[a], self.sets[b]):
                self.root[max(r, s)] = min(r, s)
                found.append((a, b))

    def _linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        at = np.searchsorted(a, b)
        at[at == len(a)] = 0
        both = int((a[at] == b).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def _candidates(classes: DataFrame, sketched: DataFrame) -> DataFrame:
    """``h`` and ``cluster`` of the classes that share an offer with another class."""
    # one shuffle: the sums and the join both use the rows dealt by offer
    offered = sketched.where(F.col("offers").isNotNull()).select("h", F.explode("offers").alias("offer")).repartition("offer")
    shared = offered.groupBy("offer").agg(F.min("h").alias("low"), F.max("h").alias("high")).where(
        F.col("low") != F.col("high")).select("offer", "low")
    edges = offered.join(shared.hint("merge"), "offer").where(F.col("h") != F.col("low")).select(
        F.col("h").alias("a"), F.col("low").alias("b")).distinct()
    return components(edges).select(F.col("id").alias("h"), F.col("component").alias("cluster"))


def blocked(members: DataFrame, block: int) -> DataFrame:
    """``members`` (h, n, cluster, ...) with the block ``own`` of each and the number of ``blocks``
    of its cluster, about ``block`` shingles each."""
    blocks = members.groupBy("cluster").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    return members.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("h"), "blocks").cast("int"))


def block_pairs(members: DataFrame) -> DataFrame:
    """One copy of each member for every pair of blocks (``i``, ``j``) that its block is in."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return members.select("*", other).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})


def _few_links(members: list[tuple], percent: int, two_blocks: bool) -> list[tuple]:
    """``_links`` of a handful of members, which would share one leaf: every pair that is not
    connected yet."""
    sets, root, out = [set(s.tolist()) for _, _, s in members], list(range(len(members))), []
    for j in range(1, len(members)):
        for i in range(j):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if root[i] == root[j] or 100 * small < percent * large or two_blocks and members[i][1] == members[j][1]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (small + large - both):
                out.append((members[i][0], members[j][0]))
                gone, to = max(root[i], root[j]), min(root[i], root[j])
                root = [to if r == gone else r for r in root]
    return out


def _links(members: list[tuple], percent: int, two_blocks: bool) -> list[tuple]:
    """Links (a, b) that connect the members (id, block, set) of one task."""
    if len(members) < 2:
        return []
    if len(members) <= FEW:
        return _few_links(members, percent, two_blocks)
    ids, sides, arrays = zip(*members)
    tree = SignatureTree(list(arrays), percent)
    found = tree.join(sides if two_blocks else None)
    return [(ids[tree.find(a)], ids[b]) for a, b in found for b in (a, b) if tree.find(a) != b]


def tree_links(tasks: DataFrame, member, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that connect the sets of each cluster, one signature tree per pair of
    blocks; ``member`` makes (id, block, set) of a row, or None.

    Rows are dealt by cluster and blocks and sorted, so a task meets one tree's members after
    the other and holds one tree at a time, however many clusters there are.
    """
    keys = ["cluster", "i", "j"]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches):
        at, members = None, []

        def batch(found):
            cols = [*zip(*found)] or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

        for b in batches:
            found = []
            for row in b.to_pylist():
                key = row["cluster"], row["i"], row["j"]
                if key != at:
                    found += _links(members, percent, at is not None and at[1] != at[2])
                    at, members = key, []
                if (m := member(row)) is not None:
                    members.append(m)
            yield batch(found)
        yield batch(_links(members, percent, at is not None and at[1] != at[2]))

    return map_batches(tasks.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE,
                       percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """``doc_id`` (the key), ``n_shingles`` and ``component_id`` of every row."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    with small_batches(spark):
        sketched = written(sketch(docs, "doc_id", "text", size, percent), "sketch")
    known = sketched.where(F.col("doc_id").isNotNull() & F.col("h").isNotNull())
    classes = written(known.groupBy("h").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n")), "classes")
    clustered = _candidates(classes, known).join(classes, "h")
    clustered = written(clustered, "clustered")
    texts = blocked(clustered, block).join(docs.withColumnRenamed("doc_id", "rep").hint("merge"), "rep")
    tasks = block_pairs(texts)

    def member(row: dict):
        s = shingle_set(row["text"], size)
        return (row["rep"], row["own"], s) if len(s) and set_hash(s) == row["h"] else None

    edges = tree_links(tasks, member, percent)
    # rows of one id are one document, whatever their texts
    twice = known.groupBy("doc_id").agg(F.min("h").alias("x"), F.max("h").alias("y")).where("x != y").select("doc_id")
    same = known.join(twice, "doc_id", "left_semi").join(classes, "h").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    with small_batches(spark):
        links = written(edges.unionByName(same), "links")
    found = components(links)
    out = sketched.drop("offers").join(classes.select("h", "rep").hint("merge"), "h", "left").join(
        found.select(F.col("id").alias("rep"), "component").hint("merge"), "rep", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
        "component", "rep", "doc_id")).alias("component_id"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))
