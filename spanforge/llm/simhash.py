"""SimHash near-duplicates by anchor-point covering.

A fingerprint is 64 majority bits of the hashes of a text's word shingles.  Its bits are cut into three blocks of 23, 23 and 18.
Two fingerprints that differ in at most THRESHOLD = 4 bits differ by at most 1, 1 and 0 bits in one of those blocks (if they
differed by 2, 2 and 1 or more, that would be 5).  The anchors of a 23-bit block are the words of the binary Golay code: a perfect covering
code of radius 3, so every value has exactly one home anchor, and values at most 1 apart meet at the home anchor of either
if each is also sent to all anchors within 3 + 1.  That is 5.3 anchors on average.  The anchors of the last block are its values
themselves (radius 0).  Members of an anchor are compared by whole fingerprint, in numpy, and only a spanning forest of the links leaves the
task.  Components of the forest are found by alternating large and small stars in DataFrame joins.

Only distinct fingerprints are compared, so copies cost nothing.  Members of an anchor with many are dealt once more: the bits outside
the anchor's block are cut into THRESHOLD + 1 chunks, at least one of which is equal in two linked fingerprints, and only members that share a
chunk meet.  So members sent grow in proportion to the fingerprints.

Defined results: null and wordless texts have fingerprint zero and link like any other; rows with a null doc_id take part, and
a component without any doc_id has a null id; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, arrow_map, counted_join, cut, narrow, nested, packed, removed, row_key, texts_of

THRESHOLD, SHINGLE, SEED = 4, 4, 42
_LOW = (1 << 23) - 1
#: Bits of the last block that name its anchor; the whole fingerprints are compared anyway.
LAST_BITS = 14
#: Bits outside the block, and by how many bits a fingerprint is turned right so that those are its lowest.
OUTSIDE, TURN = (41, 41, 46), (23, 46, 0)
#: Members at home beyond which an anchor's members are dealt by chunks.
PART = 4_000
#: Pairs compared at once.
CELLS = 1 << 21
#: Generator polynomial of the binary Golay code of length 23.
GENERATOR = 0b101011100011

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases and splits ASCII only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    width = min(SHINGLE, n)
    to = ends[width - 1 :].tolist()
    starts = [0, *(ends[: n - width] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter([h(joined[a:b], SEED) for a, b in zip(starts, to, strict=True)], np.uint64, len(to))
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(to)).tobytes(), "big")


def fingerprints(docs: DataFrame, *more: str) -> DataFrame:
    """The named columns and fp, the fingerprint as a signed long."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in texts_of(batch)], np.uint64).view(np.int64)
        return pa.record_batch({**{c: batch.column(c) for c in more}, "fp": pa.array(found)})

    kinds = dict(docs.dtypes)
    return arrow_map(docs, over, ", ".join([*(f"{c} {kinds[c]}" for c in more), "fp bigint"]))


def _remainders() -> np.ndarray:
    """Syndrome of each 23-bit value's upper and lower halves is taken from tables of polynomial remainders."""
    powers = []
    x = 1
    for _ in range(23):
        powers.append(x)
        x <<= 1
        if x >> 11:
            x ^= GENERATOR
    return np.array(powers, np.int64)


_POWERS = _remainders()


def syndrome(values: np.ndarray) -> np.ndarray:
    """Remainder of each value's polynomial by the generator: zero for the code's words."""
    out = np.zeros(len(values), np.int64)
    for k in range(23):
        out ^= np.where(values >> k & 1, _POWERS[k], 0)
    return out


def _errors(weight: int) -> np.ndarray:
    out = np.zeros(1, np.int64)
    for _ in range(weight):
        out = np.unique((out[:, None] | (1 << np.arange(23))).ravel())
    return out[np.bitwise_count(out) == weight]


def _leaders() -> tuple[np.ndarray, list[np.ndarray]]:
    """By syndrome: the one pattern of weight at most 3, and all patterns of weight 4."""
    small = np.concatenate([_errors(w) for w in range(4)])
    near = np.zeros(2048, np.int64)
    near[syndrome(small)] = small
    four = _errors(4)
    key = syndrome(four)
    order = np.argsort(key, kind="stable")
    return near, np.split(four[order], np.cumsum(np.bincount(key, minlength=2048))[:-1])


NEAR, FAR = _leaders()


def anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For 23-bit values: row, anchor and home for every anchor within 4 bits; the nearest, within 3, is home."""
    s = syndrome(values)
    home = values ^ NEAR[s]
    many = np.array([len(x) for x in FAR])[s]
    row = np.repeat(np.arange(len(values)), many)
    far = np.concatenate([FAR[k] for k in s]) if len(s) else np.zeros(0, np.int64)
    at = np.concatenate([np.arange(len(values)), row])
    return at, np.concatenate([home, values[row] ^ far]), np.arange(len(at)) < len(values)


def cover(distinct: DataFrame) -> DataFrame:
    """fp -> anchor, fp, home: each fingerprint at every anchor it has to be compared at."""

    def over(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            u = fp.view(np.uint64)
            parts = []
            for block, shift in ((0, 0), (1, 23)):
                row, anchor, home = anchors((u >> np.uint64(shift)).astype(np.int64) & _LOW)
                parts.append((anchor + (block << 32), fp[row], home))
            parts.append(((u >> np.uint64(64 - LAST_BITS)).astype(np.int64) + (2 << 32), fp, np.ones(len(fp), bool)))
            a, f, h = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.record_batch({"anchor": a, "fp": f, "home": h})

    return distinct.select("fp").mapInArrow(over, "anchor bigint, fp bigint, home boolean")


def forest(fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between members at most THRESHOLD bits apart, at least one of them at home, reduced to a spanning forest."""
    u = fp.view(np.uint64)
    parent = list(range(len(u)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    a: list[int] = []
    b: list[int] = []
    homes = np.flatnonzero(home)
    step = max(1, CELLS // max(1, len(u)))
    for i in range(0, len(homes), step):
        rows = homes[i : i + step]
        close = np.bitwise_count(u[rows][:, None] ^ u[None, :]) <= THRESHOLD
        close[np.arange(len(rows)), rows] = False
        for own, other in zip(*(x.tolist() for x in np.nonzero(close)), strict=True):
            x, y = top(int(rows[own])), top(other)
            if x != y:
                a.append(int(rows[own]))
                b.append(other)
                parent[x] = y
    return fp[a], fp[b]


def chunks(block: int) -> Column:
    """The chunk numbers and values, in one long each, of the bits of fp outside a block."""
    low = F.col("fp") if not TURN[block] else F.shiftrightunsigned("fp", TURN[block]).bitwiseOR(F.shiftleft("fp", 64 - TURN[block]))
    ends = [OUTSIDE[block] * k // (THRESHOLD + 1) for k in range(THRESHOLD + 2)]
    return F.array(*[F.shiftrightunsigned(low, a).bitwiseAND((1 << (b - a)) - 1) + (k << 32) for k, (a, b) in enumerate(zip(ends, ends[1:]))])


def links(distinct: DataFrame) -> DataFrame:
    """a, b: fingerprints whose links connect what is at most THRESHOLD bits apart."""
    placed = cover(distinct)
    # At most 2 * 4096 + 2**LAST_BITS anchors exist, so the list of crowded ones may be broadcast.
    crowded = placed.where("home").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > PART).select("anchor", F.lit(True).alias("many"))
    dealt = placed.join(F.broadcast(crowded), "anchor", "left")
    block = F.shiftright("anchor", 32)
    parts = F.when(F.col("many"), F.when(block == 0, chunks(0)).when(block == 1, chunks(1)).otherwise(chunks(2))).otherwise(F.array(F.lit(-1).cast("bigint")))
    sent = dealt.select("anchor", F.explode(parts).alias("part"), "fp", "home")

    def over(table: pa.Table) -> pa.Table:
        fp, home = table.column("fp").to_numpy(), table.column("home").to_numpy(zero_copy_only=False)
        order = np.argsort(fp, kind="stable")
        a, b = forest(np.ascontiguousarray(fp[order]), home[order])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return sent.groupBy("anchor", "part").applyInArrow(over, "a bigint, b bigint")


def connected(edges: DataFrame) -> DataFrame:
    """node, root: for every node of the edges a, b the smallest node it can reach (large and small stars in turn)."""
    now = Stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().transform(packed), "stars")
    before = None
    while True:
        # large star: every larger neighbour is linked to the least one; hubs are dealt over partitions
        both = now.table.union(now.table.select("b", "a"))
        least = cut(packed(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")))
        large = cut(packed(counted_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()))
        # small star: a node and its smaller neighbours are linked to the least one
        low = cut(packed(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))))
        near = counted_join(large, low, ["a"])
        now = now.replaced(packed(near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()), "stars")
        state = now.table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = cut(now.table.select(F.col("a").alias("node"), F.col("b").alias("root")))
            removed(edges.sparkSession, now.folder)
            return roots
        before = state


def components(prints: DataFrame) -> DataFrame:
    """fp, n (rows with it), root, component_id: the component of each distinct fingerprint of (doc_id, fp) and the smallest doc_id in it."""
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    roots = connected(links(distinct))
    rooted = cut(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", "rows", F.coalesce("root", "fp").alias("root")))
    ids = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    return cut(counted_join(rooted, ids, ["root"]).select("fp", F.col("rows").alias("n"), "root", "component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id: one row per document."""
    prints = cut(fingerprints(narrow(docs, "doc_id", "text"), "doc_id"))
    return counted_join(prints, components(prints), ["fp"]).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def firsts(prints: DataFrame, node: str) -> DataFrame:
    """A node's first document (no_id, doc_id, key_a, key_b) and how many rows are equal to that; copies are counted before the shuffles."""
    rows = prints.groupBy(node, "key_a", "key_b").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key_a", "key_b", "n"))
    return rows.groupBy(node).agg(least.alias("first")).select(node, "first.*")


def first_of(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """The first of docs' rows for each root by smallest doc_id, then least key; rooted has the firsts of nodes and root."""
    least = F.min(F.struct("no_id", "doc_id", "key_a", "key_b", "n")).alias("first")
    winners = cut(rooted.groupBy("root").agg(least).select("first.key_a", "first.key_b", "first.n"))
    whole = nested(docs, "doc_id", "text").select("document", *row_key())
    found = counted_join(whole, winners, ["key_a", "key_b"])
    # equal rows are one each per partition before they meet
    nth = F.row_number().over(Window.partitionBy("key_a", "key_b").orderBy(F.lit(1)))
    return found.withColumn("nth", nth).where("nth = 1").select("document.*")


def keep(docs: DataFrame) -> DataFrame:
    """The documents with one left of each component: the smallest doc_id, of rows that share it the one with the least key."""
    keyed = narrow(docs, "doc_id", "text").select("doc_id", "text", *row_key())
    prints = cut(fingerprints(keyed, "doc_id", "key_a", "key_b"))
    return first_of(docs, firsts(prints, "fp").join(components(prints).select("fp", "root"), "fp"))
