"""MinHash near-duplicate detection by an inverted join of signature coordinates.

The first coordinates of a document's signature are a set of (coordinate, value) elements.  Two documents whose shingle
sets have the wanted similarity agree in so many of them, but for a chance of one in a million at the threshold itself, that
they share an element among the first few of each side, in any order common to all documents (prefix); frequent
elements come last in that order, so common passages are seldom posted.  Within a posting list, agreements in all
coordinates are counted only for pairs whose sizes allow the similarity and that are not yet connected (skip), and pairs
with too few are dropped.  Links are then confirmed on the full shingle sets, in long lists after a comparison of parities
that no link can fail.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.llm.interning import mix, text_chunks, words_of
from leafpress.operators.components import connected_components
from leafpress.storage import materialize

#: Coordinates that are posted, and coordinates that are counted, with so many bits of each kept for counting.
COORDINATES, COUNTED, BITS = 32, 128, 4
#: Classes of shingles whose parities are compared before full sets are.
PARITIES = 4096
#: Chance that a pair at the threshold has fewer agreements than the match threshold.
MISS = 1e-6
#: Counters of element frequency, whatever the input; they only order elements, so sharing one is harmless.
COUNTERS = 1 << 18
#: Longer posting lists are linked through a few of their members first.
SHORT_LIST = 16
#: Most central members of a long list that each of its members is compared with.
PIVOTS = 4
#: Members of a long list that meet in one group at most, and ids that are broadcast at most.
BLOCK, SENT_IDS = 512, 1_000_000
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LANES = COUNTED * BITS // 64


_SEEDS = mix(np.arange(1, 2 * COUNTED + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_MULTIPLY, _ADD = (_SEEDS[:COUNTED] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (_SEEDS[COUNTED:] >> np.uint64(32)).astype(np.uint32)


def match_threshold(coordinates: int, agree: float, miss: float = MISS) -> int:
    """The most agreements that a pair, agreeing in each coordinate with probability ``agree``, falls short of with at most ``miss``."""
    total, k = 0.0, 0
    while total <= miss:
        total += math.exp(math.lgamma(coordinates + 1) - math.lgamma(k + 1) - math.lgamma(coordinates - k + 1) + k * math.log(agree) + (coordinates - k) * math.log(1 - agree))
        k += 1
    return k - 1


def shingle_sets(column: pa.Array, words_in: int) -> list[np.ndarray]:
    """Per text, the sorted distinct 64-bit hashes of its shingles of ``words_in`` words.

    Words are runs of bytes other than ASCII white space, A-Z in lower case.  With fewer words, the
    sequence is one shingle; without words, the set is empty.
    """
    words = words_of(column, lower=True)
    h, n = words.hashes(), words.counts
    ends = np.cumsum(n)
    s = np.zeros(max(0, len(h) - words_in + 1), np.uint64)
    for k in range(words_in):
        s = s * _STEP + h[k : k + len(s)]
    s = mix(s + np.uint64(words_in))
    out = []
    for a, e in zip((ends - n).tolist(), ends.tolist(), strict=True):
        if e - a >= words_in:
            x = np.sort(s[a : e - words_in + 1])
            out.append(x[np.r_[True, x[1:] != x[:-1]]])
        else:
            x = np.zeros(min(1, e - a), np.uint64)
            for k in range(e - a):
                x = x * _STEP + h[a + k]
            out.append(mix(x + np.uint64(e - a)))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, as unsigned 32-bit."""
    least = np.full(COUNTED, np.iinfo(np.uint32).max, np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(folded), 128):
        x = folded[a : a + 128, None] * _MULTIPLY
        x += _ADD
        np.minimum(least, x.min(axis=0), out=least)
    return (mix(least.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Of each of ``PARITIES`` classes of shingles, whether the set holds an odd number; packed into longs.

    Two sets differ in at least as many shingles as their parities differ in bits.
    """
    odd = np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def lanes(signs: np.ndarray) -> np.ndarray:
    """The last bits of all coordinates, packed."""
    low = (signs & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (low[..., 0::2] | low[..., 1::2] << np.uint8(4)).view("<i8")


def signatures(docs: DataFrame, id_col: str, text_col: str, words_in: int) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, posted coordinates, bits of the counted ones, parities); null for empty sets but the first two."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = shingle_sets(chunk.column("text"), words_in)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                signs = [signature(s) if len(s) else None for s in sets]
                posted = [None if x is None else x[:COORDINATES].view(np.int32) for x in signs]
                counted = [None if x is None else lanes(x) for x in signs]
                odd = [parities(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(posted, pa.list_(pa.int32())), *(pa.array(x, pa.list_(pa.int64())) for x in (counted, odd))], ["doc_id", "n_shingles", "digest", "sig", "lanes", "odd"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, sig array<int>, lanes array<long>, odd array<long>")


def _elements(signs: np.ndarray) -> np.ndarray:
    """A 64-bit key for each (coordinate, value)."""
    return (np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)) | signs.astype(np.uint64)


def prefixes(nodes: DataFrame, matches: int) -> DataFrame:
    """(node, prefix): the elements a node is posted under, in the common order."""
    keep = COORDINATES - matches + 1
    counted = nodes.select(F.posexplode("sig").alias("c", "v")).groupBy(F.pmod(F.xxhash64("c", "v"), F.lit(COUNTERS)).alias("slot")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    often = counted.where(F.col("n") > 8 + 4 * total / COUNTERS).collect()  # under a quarter of the counters
    frequent = np.zeros(COUNTERS, np.int64)
    for r in often:
        frequent[r["slot"]] = r["n"]
    with_slots = nodes.withColumn("slots", F.expr(f"transform(sig, (v, c) -> pmod(xxhash64(c, v), {COUNTERS}))"))

    def post(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 4000):
                part = batch.slice(a, 4000)
                signs = part.column("sig").flatten().to_numpy().view(np.uint32).reshape(-1, COORDINATES)
                slots = part.column("slots").flatten().to_numpy().reshape(-1, COORDINATES)
                keys = _elements(signs)
                order = np.lexsort((keys, mix(keys), frequent[slots]), axis=1)[:, :keep]
                keys = np.take_along_axis(keys, order, axis=1).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keep, dtype=np.int32)), pa.array(np.ascontiguousarray(keys).ravel()))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "prefix"])

    return with_slots.select("node", "sig", "slots").mapInArrow(post, "node binary, prefix array<long>")


def _agreements(a: str, b: str) -> Column:
    """In how many coordinates the kept bits agree."""
    parts = []
    for k in range(_LANES):
        any_bit = f"({a}s{k} ^ {b}s{k})"
        for step in (2, 1):  # the lowest of a coordinate's bits becomes the OR of them
            any_bit = f"({any_bit} | shiftrightunsigned({any_bit}, {step}))"
        parts.append(f"{64 // BITS} - bit_count({any_bit} & {0x1111111111111111}L)")
    return F.expr(" + ".join(parts))


def _may_link(a: str, b: str, percent: int, matches: int) -> Column:
    return F.expr(f"100 * least({a}n, {b}n) >= {percent} * greatest({a}n, {b}n)") & (_agreements(a, b) >= matches)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def confirm(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(sets.selectExpr("node as a", "shingles as set_a"), "a")
    return left.join(sets.selectExpr("node as b", "shingles as set_b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(confirm, "a binary, b binary")


def _sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words_in: int) -> DataFrame:
    """(node, shingles) of the documents that stand for the nodes in ``ids`` (node, doc_id), a written table."""

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch):
                sets = shingle_sets(chunk.column("text"), words_in)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    wanted = ids.select("doc_id")
    wanted = F.broadcast(wanted) if ids.count() <= SENT_IDS else wanted
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(wanted, "doc_id", "left_semi")
    # an id may come with several texts: only those of the nodes are wanted, and each once
    return rows.select("text").mapInArrow(shingle, "node binary, shingles binary").join(ids.select("node"), "node", "left_semi").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable over links) and ``kept``.

    Documents link when 100 * intersection >= percent * union of their sets of ``words_in``-word shingles.
    Equal sets are one node, so copies are never paired with each other.  Null or empty text: no
    shingles, linked with nothing, kept.  Null id: linked with nothing, no component, kept.  Repeated rows of one id: same component.
    Other columns are ignored; an empty table gives no rows.
    """
    signed = materialize(signatures(docs, id_col, text_col, words_in), "signatures")
    nodes = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in ("sig", "lanes", "odd")))
    nodes = materialize(nodes.withColumnRenamed("digest", "node"), "nodes")
    wanted = percent / 100
    prefixed = materialize(prefixes(nodes, match_threshold(COORDINATES, wanted)), "prefixes")
    posted = prefixed.select(F.posexplode("prefix").alias("place", "key"), "node")
    matches = match_threshold(COUNTED, wanted + (1 - wanted) / (1 << BITS))
    # Posting lists with two members or more; in short ones, every pair
    sizes = materialize(posted.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    few = materialize(posted.join(sizes, "key").join(nodes.select("node", "n", *(F.get("lanes", F.lit(k)).alias(f"s{k}") for k in range(_LANES))), "node"), "lists")
    short, long_ = few.where(f"size <= {SHORT_LIST}"), few.where(f"size > {SHORT_LIST}")
    near = _pairs(short, short, "x.key = y.key and x.node < y.node", percent, matches)
    # In long ones, each member with the most central ones: those whose lists are longest
    central = long_.groupBy("node").agg(F.sum("size").alias("central"))
    order = Window.partitionBy("key").orderBy(F.desc("central"), "node")
    pivots = materialize(long_.join(central, "node").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PIVOTS), "pivots")
    starred = _pairs(long_, pivots, "x.key = y.key and x.node <> y.node", percent, matches)
    links = _links(docs, nodes, near.union(starred).distinct(), id_col, text_col, words_in, percent)
    labels = connected_components(links)
    apart = _apart(long_, prefixed, nodes, labels, percent, matches)
    if apart.limit(1).count():
        links = links.union(_links(docs, nodes, apart, id_col, text_col, words_in, percent))
        labels = connected_components(links)
    # The smallest id of a component
    own = materialize(nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "own")
    smallest = own.groupBy("component").agg(F.min("doc_id").alias("least"))
    found = materialize(own.join(smallest, "component").select(F.col("node").alias("digest"), "least"), "found")
    # Copies share a digest, whose rows Spark may split; rows without one get a key that no digest equals
    rows = signed.select("doc_id", "n_shingles", F.expr("coalesce(if(doc_id is null, cast(concat('-', hex(digest)) as binary), digest), cast(concat('-', doc_id) as binary))").alias("digest"))
    return rows.join(found, "digest", "left").selectExpr("doc_id", "n_shingles", "coalesce(least, doc_id) as component_id", "coalesce(doc_id = coalesce(least, doc_id), true) as kept")


def _pairs(x: DataFrame, y: DataFrame, rule: str, percent: int, matches: int, last: str = "true") -> DataFrame:
    """(a, b), a before b, of postings that obey ``rule``, may link, and obey ``last``, which is looked at last."""
    rows = x.alias("x").join(y.alias("y"), F.expr(rule) & _may_link("x.", "y.", percent, matches) & F.expr(last))
    return rows.selectExpr("least(x.node, y.node) as a", "greatest(x.node, y.node) as b")


def _apart(long_: DataFrame, prefixed: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs (a, b) of members of a long list that are not connected yet and may link.

    Members outside a list's largest component meet all its members, in groups of a block of the ones and a block of the
    others, so that no group grows with a list.  A pair is looked at in the first list that both are in.  Pairs whose parities differ
    in more shingles than linked sets can are dropped.
    """
    rows = long_.select("key", "place", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = materialize(rows, "members")
    largest = rows.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.max("n").alias("n"), F.sum("n").alias("members")).where("n < members")
    blocks = materialize(largest.selectExpr("key", "largest", f"cast(ceil((members - n) / {BLOCK}) as int) as p_blocks", f"cast(ceil(members / {BLOCK}) as int) as q_blocks"), "blocks")
    about = prefixed.join(nodes.select("node", "n", "odd", *(F.get("lanes", F.lit(k)).alias(f"s{k}") for k in range(_LANES))), "node")
    rows = materialize(rows.join(blocks, "key").join(about, "node").withColumn("earlier", F.expr("slice(prefix, 1, place)")).drop("prefix"), "mixed")
    x = rows.where("component <> largest").selectExpr("*", "cast(pmod(xxhash64(node, 1), p_blocks) as int) as p", "explode(sequence(0, q_blocks - 1)) as q")
    y = rows.selectExpr("*", "cast(pmod(xxhash64(node, 2), q_blocks) as int) as q", "explode(sequence(0, p_blocks - 1)) as p")
    rule = "x.key = y.key and x.p = y.p and x.q = y.q and x.component <> y.component and (y.component = y.largest or x.node < y.node)"
    # 100 * common >= percent * union, where x.n + y.n = union + common and the sets differ in union - common
    differ = "aggregate(zip_with(x.odd, y.odd, (p, q) -> bit_count(p ^ q)), 0, (s, n) -> s + n)"
    last = f"not arrays_overlap(x.earlier, y.earlier) and (100 + {percent}) * {differ} <= (100 - {percent}) * (x.n + y.n)"
    return materialize(_pairs(x, y, rule, percent, matches, last).distinct(), "apart")


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, id_col: str, text_col: str, words_in: int, percent: int) -> DataFrame:
    pairs = materialize(pairs, "pairs")
    needed = pairs.selectExpr("a as node").union(pairs.selectExpr("b as node")).distinct()
    ids = materialize(nodes.join(needed, "node").select("node", "doc_id"), "needed")
    sets = materialize(_sets(docs, ids, id_col, text_col, words_in), "sets")
    return materialize(_confirmed(pairs, sets, percent), "links")
