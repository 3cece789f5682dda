"""Near copies by 5-word shingles: SimHash candidates by anchor-point covering, decided by exact Jaccard similarity.

Texts with equal sets of shingles are one node.  Each node has 256 majority bits (2,048 after the first round) of its distinct shingles' hashes;
a similarity of 0.8 makes a bit differ with probability 0.15.  The bits are cut into 11 blocks of 23, each covered by the Golay code as in ``simhash``: nodes that
share an anchor in any block, at home for one of them, differ in few enough bits (RADII) and have sizes that allow LEAST are candidates.  A pair
at 0.8 is found with probability of about 0.99, a closer one with more.  Candidates link only if their sets of shingles have a Jaccard similarity
of LEAST percent or more.

At first an anchor's home members propose the spanning forest of least distances among them, and each of its trees its nearest candidate from
elsewhere: one proposal a member at most, and most links of a large group of near copies are among them.  After that, members that had
other candidates meet those again and propose their nearest ones of other components, FEW of them, and GROW times as many in each further round,
until none had more: no candidate is left out.  A pair that has met at its home member's anchor of an earlier block is not proposed again: there it was
proposed, or that member asks for more.  Links of a group of n near copies cost a multiple of n proposals; pairs of it that are just under
LEAST percent have to be told apart by their sets, and how many those are depends on the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import arrow_map, cut, narrow, packed, row_key, texts_of

SHINGLE, LEAST, SEED = 5, 80, 42
WORDS, BLOCKS = 4, 11
#: Words of bits at first and in later rounds, and how many bits a candidate may differ in: 3.4 standard deviations beyond what 0.8 makes.
FINE, RADII = 32, {4: 58, 32: 365}
FEW, GROW = 16, 16
#: Nearest candidates of a member among which two are sought that make another member ask by itself.
SEEN = 8
#: Members of an anchor that one task compares at home.
PART = 20_000
_SKETCH = [*(f"w{k}" for k in range(WORDS)), "size"]
_GOLDEN, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle, a wordless one has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases and splits ASCII only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    width = min(SHINGLE, n)
    to = ends[width - 1 :].tolist()
    starts = [0, *(ends[: n - width] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return np.unique(np.fromiter([h(joined[a:b], SEED) for a, b in zip(starts, to, strict=True)], np.uint64, len(to)))


def node_of(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED)


def bits_of(found: np.ndarray, words: int = WORDS) -> list[int]:
    """So many words of 64 majority bits each."""
    out = []
    for k in range(words):
        x = (found ^ (found >> np.uint64(31))) * np.uint64(_GOLDEN * (2 * k + 1) & _ALL)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        octets = (x ^ (x >> np.uint64(32))).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ simhash._BITS for k in range(8)])
        out.append(int.from_bytes(np.packbits(2 * ones > len(found)).tobytes(), "big"))
    return out


def prints_of(docs: DataFrame) -> DataFrame:
    """doc_id, key_a, key_b, node, the words of bits and the size of its set: one row per document."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(node_of(s), *bits_of(s), len(s)) for s in map(shingles, texts_of(batch))]
        values = np.array(rows, np.uint64).view(np.int64)
        return pa.record_batch({**{c: batch.column(c) for c in ("doc_id", "key_a", "key_b")}, "node": pa.array(values[:, 0]), **{c: pa.array(values[:, k + 1]) for k, c in enumerate(_SKETCH)}})

    keyed = narrow(docs, "doc_id", "text").select("doc_id", "text", *row_key())
    return arrow_map(keyed, over, "doc_id bigint, key_a bigint, key_b bigint, node bigint, " + ", ".join(f"{c} bigint" for c in _SKETCH))


def sketches(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    """n rows of words of bits and, last, the size."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(n, -1)


def blocks_of(sketch: np.ndarray) -> np.ndarray:
    """The values of the BLOCKS blocks of 23 bits, one row per sketch."""
    bits = np.ascontiguousarray(sketch[:, :WORDS])
    flat = np.unpackbits(bits.astype(">u8").view(np.uint8).reshape(len(bits), -1), axis=1)[:, : 23 * BLOCKS].reshape(len(bits), BLOCKS, 23)
    return flat.astype(np.int64) @ (1 << np.arange(23))


def met(values: np.ndarray, mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """By block: whether others, of any shape that broadcasts with mine, are sent to the anchor where mine is at home."""
    own = values[mine]
    home = own ^ simhash.NEAR[simhash.syndrome(own.ravel())].reshape(own.shape)
    return np.bitwise_count(home ^ values[others]) <= 4


def asks(values: np.ndarray, rows: np.ndarray, near: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Whether members meet two of near (where ok), their candidates, at their home anchor of one of the blocks of values, and so ask for more there."""
    return ((met(values, rows[:, None], near) & ok[..., None]).sum(1) > 1).any(1)


def cover(nodes: DataFrame) -> DataFrame:
    """anchor, node, root, sketch, home: each node at every anchor it has to be compared at; home only for those that ask."""

    def over(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, asking = blocks_of(sketches(batch.column("sketch"), batch.num_rows)), batch.column("asks").to_numpy(zero_copy_only=False)
            for k in range(BLOCKS):
                row, anchor, home = simhash.anchors(blocks[:, k])
                at = pa.array(row)
                yield pa.record_batch({"anchor": pa.array(anchor + (k << 32)), **{c: batch.column(c).take(at) for c in ("node", "root", "sketch")}, "home": pa.array(home & asking[row])})

    return nodes.select("node", "root", "sketch", "asks").mapInArrow(over, "anchor bigint, node bigint, root bigint, sketch array<bigint>, home boolean")


def finer(sets: DataFrame) -> DataFrame:
    """node and a sketch of FINE words, the first ones as before."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [np.array([*bits_of(x, FINE), len(x)], np.uint64).view(np.int64) for x in (np.asarray(s.values.to_numpy(), np.int64).view(np.uint64) for s in batch.column("found"))]
        return pa.record_batch({"node": batch.column("node"), "sketch": pa.array(rows, pa.list_(pa.int64()))})

    return arrow_map(sets, over, "node bigint, sketch array<bigint>")


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits of sketches; one more than allowed where that is too many or the sizes differ too much."""
    words = x.shape[-1] - 1
    far = np.bitwise_count(x[..., :words] ^ y[..., :words]).sum(-1, dtype=np.int16)
    m, n = x[..., words].astype(np.int64), y[..., words].astype(np.int64)
    return np.where((far <= RADII[words]) & (100 * np.minimum(m, n) >= LEAST * np.maximum(m, n)), far, RADII[words] + 1)


def distance(sketch: np.ndarray, rows: np.ndarray | int, others: np.ndarray) -> np.ndarray:
    return apart(sketch[rows][:, None], sketch[others][None]) if isinstance(rows, np.ndarray) else apart(sketch[rows], sketch[others])


def candidates(root: np.ndarray, sketch: np.ndarray, homes: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of a home member and one of its nearest candidates in other components, and of the members that had more."""
    a, b, more = [], [], []
    radius = RADII[sketch.shape[1] - 1]
    step = max(1, simhash.CELLS // (sketch.shape[1] * max(1, len(sketch))))
    for i in range(0, len(homes), step):
        rows = homes[i : i + step]
        far = distance(sketch, rows, np.arange(len(sketch)))
        close = (far <= radius) & (root[rows][:, None] != root[None, :])
        count = close.sum(1)
        x, y = np.nonzero(close & (count <= few)[:, None])
        a.append(rows[x]), b.append(y)
        for k in np.flatnonzero(count > few):
            near = np.flatnonzero(close[k])
            a.append(np.full(few, rows[k])), b.append(near[np.argsort(far[k, near], kind="stable")[:few]])
        more.append(rows[count > few])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none), np.concatenate(more or none)


def spanning(sketch: np.ndarray, homes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs of the forest of least distances among home members (Prim's way), each tree's nearest member from elsewhere, and the members
    that have to meet again: home members with other candidates and these candidates, but for those that are known to ask elsewhere."""
    h, out = len(homes), RADII[sketch.shape[1] - 1] + 1
    elsewhere = np.ones(len(sketch), bool)
    elsewhere[homes] = False
    many, outer, nearest, again, values = np.zeros(h, np.int64), np.full(h, out, np.int16), np.zeros(h, np.int64), [np.zeros(0, np.int64)], None
    step, seen = max(1, simhash.CELLS // (sketch.shape[1] * max(1, len(sketch)))), min(SEEN, len(sketch))
    for i in range(0, h, step):
        rows = homes[i : i + step]
        far = distance(sketch, rows, np.arange(len(sketch)))
        far[np.arange(len(rows)), rows] = out
        many[i : i + step] = (far < out).sum(1)
        two = np.flatnonzero(many[i : i + step] > 1)
        if len(two):
            values = blocks_of(sketch) if values is None else values
            own, reach = rows[two], far[two]
            near = np.argpartition(reach, seen - 1, axis=1)[:, :seen]
            again.append(own[~asks(values[:, :block], own, near, np.take_along_axis(reach, near, 1) < out)])
            met_here = np.flatnonzero(elsewhere & (reach < out).any(0))
            by = reach[:, met_here].argmin(0)
            others = np.where(near[by] == own[by][:, None], met_here[:, None], near[by])
            others = np.concatenate([others, own[by][:, None]], axis=1)
            ok = (others != met_here[:, None]) & (apart(sketch[met_here][:, None], sketch[others]) < out)
            again.append(met_here[~asks(values, met_here, others, ok)])
        far[:, ~elsewhere] = out
        nearest[i : i + step] = far.argmin(1)
        outer[i : i + step] = far[np.arange(len(far)), nearest[i : i + step]]
    # only members with a candidate take part, and these are few in most anchors
    part = np.flatnonzero(many)
    own = homes[part]
    best, parent, left = np.full(len(own), out, np.int16), np.full(len(own), -1), np.ones(len(own), bool)
    a, b, trees = [], [], []
    for _ in range(len(own)):
        k = int(np.argmin(np.where(left, best, out + 1)))
        left[k] = False
        if best[k] < out:
            a.append(int(own[k])), b.append(int(own[parent[k]]))
        else:
            trees.append((out, -1, -1))
        trees[-1] = min(trees[-1], (int(outer[part[k]]), int(own[k]), int(nearest[part[k]])))
        far = distance(sketch, int(own[k]), own)
        nearer = left & (far < best)
        best[nearer], parent[nearer] = far[nearer], k
    for least, k, other in trees:
        if least < out:
            a.append(k), b.append(other)
    return np.array(a, np.int64), np.array(b, np.int64), np.unique(np.concatenate(again))


def proposals(nodes: DataFrame, few: int | None) -> DataFrame:
    """a, b: candidate pairs, a < b; and rows with b null for each node a that had more of them at some anchor.  few=None: the first round."""
    placed = cover(nodes)
    # At most BLOCKS * 4096 anchors exist, so the list of crowded ones may be broadcast.
    crowded = placed.where("home").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > PART).select("anchor", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    dealt = placed.join(F.broadcast(cut(crowded)), "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    sent = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    own = F.col("home") & (F.pmod(F.xxhash64("node"), F.col("parts")) == F.col("part"))

    def over(table: pa.Table) -> pa.Table:
        node, root = (np.ascontiguousarray(table.column(c).to_numpy()) for c in ("node", "root"))
        order = np.argsort(node, kind="stable")
        node, root = node[order], root[order]
        sketch = sketches(table.column("sketch"), len(node))[order]
        homes = np.flatnonzero(table.column("own").to_numpy(zero_copy_only=False)[order])
        block = table.column("anchor")[0].as_py() >> 32
        mine, other, more = spanning(sketch, homes, block) if few is None else candidates(root, sketch, homes, few)
        if block and len(mine):
            new = ~met(blocks_of(sketch)[:, :block], mine, other).any(1)
            mine, other = mine[new], other[new]
        # nodes are in order of their places; two home members may have proposed each other
        low, high = np.divmod(np.unique(np.minimum(mine, other) * len(node) + np.maximum(mine, other)), max(1, len(node)))
        more = node[more]
        pairs = pa.table({"a": node[low], "b": node[high]})
        return pa.concat_tables([pairs, pa.table({"a": more, "b": pa.nulls(len(more), pa.int64())})])

    # a node asks for more once, however many anchors it has more at
    return sent.select("anchor", "part", "node", "root", "sketch", own.alias("own")).groupBy("anchor", "part").applyInArrow(over, "a bigint, b bigint").distinct()


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs a, b whose sets have a Jaccard similarity of LEAST percent or more."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= LEAST * (len(x) + len(y) - both))
        return pa.record_batch({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(ok, pa.bool_()))

    one = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("found").alias("sa")), "a")
    return arrow_map(one.join(sets.select(F.col("node").alias("b"), F.col("found").alias("sb")), "b").select("a", "b", "sa", "sb"), over, "a bigint, b bigint")


def sets_of(docs: DataFrame, prints: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, found: the sorted shingle hashes of each wanted node, from one of its documents."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t) for t in texts_of(batch)]
        return pa.record_batch({"node": pa.array(np.array([node_of(s) for s in found], np.uint64).view(np.int64)), "found": pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))})

    one = prints.groupBy("node").agg(F.min(F.struct("key_a", "key_b")).alias("key")).join(wanted, "node", "left_semi").select("key.key_a", "key.key_b")
    texts = narrow(docs, "doc_id", "text").select("text", *row_key()).join(one, ["key_a", "key_b"], "left_semi").dropDuplicates(["key_a", "key_b"])
    return arrow_map(texts.select("text"), over, "node bigint, found array<bigint>")


def roots_of(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """node, root: for every node that is similar to another the least node of its component."""
    # equal sets have equal sketches, so any row of a node will do
    nodes = cut(prints.groupBy("node").agg(*[F.min(c).alias(c) for c in _SKETCH]).select("node", F.array(*_SKETCH).alias("sketch")))
    few, checked, edges, sets, roots, fine = None, None, None, None, None, None
    asking = nodes.withColumns({"root": F.col("node"), "asks": F.lit(True)})
    while True:
        told = cut(packed(proposals(asking, few)))
        found = told.where("b IS NOT NULL")
        pairs = cut(found if checked is None else found.join(checked, ["a", "b"], "left_anti"))
        if sets is None:
            # all that meet again are told of here, in pairs or alone
            named = told.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()
            sets = cut(packed(sets_of(docs, prints, named)))
        if edges is None or not pairs.isEmpty():
            new = cut(packed(similar(pairs, sets)))
            if edges is None or not new.isEmpty():
                edges = new if edges is None else edges.union(new)
                roots = simhash.connected(edges)
        checked = pairs if checked is None else checked.union(pairs)
        more = cut(told.where("b IS NULL").select(F.col("a").alias("node")))
        if more.isEmpty():
            return roots
        few = FEW if few is None else few * GROW
        # those that had no more have proposed all candidates that they met at home, but may be candidates of those that had
        fine = cut(finer(sets.join(more, "node"))) if fine is None else fine
        rooted = fine.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        asking = cut(rooted.join(more.withColumn("asks", F.lit(True)), "node", "left").withColumn("asks", F.coalesce("asks", F.lit(False))))


def keep(docs: DataFrame) -> DataFrame:
    """The documents with one left of each component: the smallest doc_id, of rows that share it the one with the least key."""
    prints = cut(prints_of(docs))
    rooted = simhash.firsts(prints, "node").join(roots_of(docs, prints), "node", "left").withColumn("root", F.coalesce("root", "node"))
    return simhash.first_of(docs, rooted)
