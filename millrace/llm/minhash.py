"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard on whole shingle sets.

Circulant MinHash has two permutations of the 32-bit universe: the first scatters the shingles, the
second, circularly shifted by k, gives coordinate k of the signature. Documents with the same set of
shingles are one node. Nodes that agree in a whole band are candidates, and each link is confirmed
on the full sets. Large groups are contracted first: every band bucket compares its nodes with one
of them, and nodes already connected need no further comparing; this goes on while it halves the pairs
that are left. All nodes of buckets still unconnected are then compared by prefix filtering on the rarest
classes of their shingles, which leaves out no pair that can be linked.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from millrace.llm.common import by_batch, texts
from millrace.llm.components import components
from millrace.storage import saved

WORDS, PERCENT = 5, 75
COORDS, ROWS = 128, 4
BANDS = COORDS // ROWS
#: Shingles whose coordinates are computed at once, to stay in a core's cache.
BLOCK = 512
#: Rounds of contraction at most, and the open pairs per node below which they are compared at once.
ROUNDS, OPEN_PER_NODE = 6, 1
#: Nodes of a class of shingles that one task compares with as many others.
CHUNK = 256
#: 64-bit words of the bitmap that bounds what two sets share.
BIT_WORDS = 16

# Finalisers of the public MurmurHash3, and odd multipliers.
MIX32 = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
MIX64 = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


def permuted(x: np.ndarray, seed: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place on a fresh uint32 array."""
    x ^= np.uint32(seed)
    x ^= x >> np.uint32(16)
    x *= MIX32[0]
    x ^= x >> np.uint32(13)
    x *= MIX32[1]
    x ^= x >> np.uint32(16)
    return x


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX64[0]
    x = (x ^ (x >> np.uint64(33))) * MIX64[1]
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Sorted different 64-bit hashes of the text's 5-word shingles (fewer words: the whole sequence as one)."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    out = np.full(n, np.uint64(min(len(words), WORDS)))
    for k in range(min(len(words), WORDS)):
        out += h[k : k + n] * ODD[k]
    return np.unique(mixed(out))


SHIFTS = np.arange(COORDS, dtype=np.uint32)


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """``COORDS`` coordinates: the least value of the k times shifted permutation over the set."""
    places = permuted((shingle_set ^ (shingle_set >> np.uint64(32))).astype(np.uint32), 0x5BD1E995)
    least = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(places), BLOCK):
        shifted = places[start : start + BLOCK, None] + SHIFTS  # wraps around: a circular shift
        np.minimum(least, permuted(shifted, 0x1B873593).min(axis=0), out=least)
    return least


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature its bands' keys."""
    own = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * ODD[4]
    for k in range(ROWS):
        keys = mixed(keys + own[:, :, k] * ODD[k])
    return keys.view(np.int64)


def sketches(df: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, a 128-bit digest of the shingle set, and band keys."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in texts(batch)]
        keys = band_keys(np.stack([signature(s) for s in sets]))
        digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        flat = pa.array(keys.reshape(-1), pa.int64())
        offsets = pa.array(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
            ["doc_id", "n_shingles", "digest", "bands"],
        )

    return df.mapInArrow(by_batch(run), "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>")


def bitmap(shingle_set: np.ndarray) -> np.ndarray:
    """A bit for each class of shingles that the set has: a bit that another set lacks is a shingle it lacks."""
    bits = np.zeros(64 * BIT_WORDS, np.uint8)
    bits[shingle_set % np.uint64(64 * BIT_WORDS)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles, bits, set): the whole sets, their bitmaps and hashes, of the documents that ``nodes`` names."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t) for t in texts(batch)]
        out = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
        bits = pa.array([bitmap(s) for s in sets], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), digests, out, bits], ["node", "digest", "shingles", "bits"])

    named = docs.join(nodes.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    found = named.mapInArrow(by_batch(run), "node bigint, digest binary, shingles array<bigint>, bits array<bigint>")
    return found.dropDuplicates(["node", "digest"]).drop("digest").withColumn("set", F.xxhash64("shingles"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    of = lambda side: sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - common
    return pairs.join(of("a"), "a").join(of("b"), "b").where(100 * common >= percent * union).select("a", "b").distinct()


def star_pairs(still: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each bucket one of its nodes with those that aren't connected with it and whose sizes allow a link.

    The node that meets most others in its buckets leads, in later turns weighed by chance.
    """
    chance = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1000)) if turn else F.lit(1)
    first = F.struct((F.col("meets") * chance).alias("h"), "node", "n", "comp")
    leaders = still.groupBy("key").agg(F.max(first).alias("l")).select("key", "l.*").toDF("key", "h", "node_l", "n_l", "comp_l")
    fits = (F.col("comp") != F.col("comp_l")) & (100 * F.least("n", "n_l") >= percent * F.greatest("n", "n_l"))
    pairs = still.join(leaders, "key").where(fits)
    return pairs.select(F.least("node", "node_l").alias("a"), F.greatest("node", "node_l").alias("b")).distinct()


def prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of unconnected ``nodes`` (node, comp) that can be linked, and few others.

    Shingles that exactly the same sets hold are one class, weighed by their number, so what two sets
    share is met class by class and not shingle by shingle. Two sets of such similarity share a class
    among the rarest of each: of n shingles those before the ceil(n * percent / 100)-th last. The nodes
    of the largest component of a class are paired with the others only, so a large group costs no more
    than its size for each of those. Both sides of a class are dealt into chunks of about ``CHUNK`` nodes,
    and chunk meets chunk, so that no class is one task.
    """
    each = sets.drop("bits").join(nodes, "node").withColumn("n", F.size("shingles")).select("node", "comp", "n", "set", F.explode("shingles").alias("shingle"))
    # who holds a shingle, as 128 bits: each holder has it once, so hashes that cancel out in pairs keep all of them and no order
    holders = [F.bit_xor(F.xxhash64("node", "set", F.lit(k))).alias(f"p{k}") for k in (1, 2)]
    often = each.groupBy("shingle").agg(F.count("*").alias("rows"), (F.min("comp") < F.max("comp")).alias("parted"), *holders).where("rows > 1")
    of_class = ["rows", "p1", "p2"]
    common = each.join(often, "shingle").groupBy("node", "set", *of_class).agg(
        *[F.first(c).alias(c) for c in ("comp", "n", "parted")], F.count("*").alias("weight")
    )
    by_set = W.Window.partitionBy("node", "set")
    alone = F.col("n") - F.sum("weight").over(by_set)  # shingles of this set only come first
    upto = F.sum("weight").over(by_set.orderBy(*of_class).rowsBetween(W.Window.unboundedPreceding, 0))
    ranked = common.withColumn("alone", alone).withColumn("nth", upto)
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    ranked = ranked.where((F.col("alone") + F.col("nth") - F.col("weight") < length) & F.col("parted"))
    prefix = saved(ranked.select(*of_class, "node", "set", "comp", "n", F.col("alone").cast("int").alias("alone"), F.col("nth").cast("int").alias("nth"), F.col("weight").cast("int").alias("weight")), "minhash-prefixes")
    by_comp = prefix.groupBy(*of_class, "comp").agg(F.count("*").alias("held"))
    largest = by_comp.groupBy(*of_class).agg(F.max_by("comp", F.struct("held", "comp")).alias("largest"), F.count("*").alias("comps"), F.sum("held").alias("all"), (F.sum("held") - F.max("held")).alias("small")).where("comps > 1")
    chunks = lambda held: F.ceil(F.col(held) / CHUNK).cast("int")
    largest = largest.select(*of_class, "largest", chunks("all").alias("chunks"), chunks("small").alias("chunks_l"))
    # a row knows how many hold its class, so its salt needs no look-up
    salts = F.ceil(F.col("rows") / CHUNK).cast("int")
    largest = largest.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    prefix = prefix.withColumn("salt", F.pmod(F.xxhash64("node", "set"), salts).cast("int"))
    flagged = prefix.join(largest, [*of_class, "salt"]).drop("salt").withColumn("large", F.col("comp") == F.col("largest")).drop("largest")
    chunk = F.xxhash64("node", "set")
    flagged = flagged.withColumn("chunk", F.pmod(chunk, "chunks").cast("int")).withColumn("chunk_l", F.pmod(chunk, "chunks_l").cast("int"))
    # bitmaps come from the saved sets, whose shingles stay where they are
    words = sets.select("node", "set", *[F.col("bits")[k].alias(f"bits_{k}") for k in range(BIT_WORDS)])
    flagged = saved(flagged.join(words, ["node", "set"]).drop("set"), "minhash-flagged")
    renamed = lambda c: c.replace("bits_", "bits_l_") if c.startswith("bits_") else f"{c}_l"
    # a node of chunk i meets all chunks of the others, one of the others' chunk j all chunks of the class
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = [*of_class, "chunk", "chunk_l"]
    others = flagged.where("not large").withColumn("chunk", every("chunks")).drop("large", "chunks", "chunks_l")
    others = others.select(*met, *[F.col(c).alias(renamed(c)) for c in others.columns if c not in met])
    flagged = flagged.withColumn("chunk_l", every("chunks_l")).drop("chunks", "chunks_l")
    fits = (F.col("comp") != F.col("comp_l")) & (F.col("large") | (F.col("node_l") < F.col("node")))
    # shared at most, if this is the first class that both hold (one before it gives the pair already): it and what is left behind it
    most = F.col("weight") + F.least(F.col("n") - F.col("alone") - F.col("nth"), F.col("n_l") - F.col("alone_l") - F.col("nth_l"))
    lacks = lambda a, b: reduce(add, [F.bit_count(F.col(f"{a}{k}").bitwiseAND(F.bitwise_not(F.col(f"{b}{k}")))) for k in range(BIT_WORDS)])
    for bound in (most, F.col("n") - lacks("bits_", "bits_l_"), F.col("n_l") - lacks("bits_l_", "bits_")):
        fits &= (100 + percent) * bound >= percent * (F.col("n") + F.col("n_l"))
    pairs = flagged.join(others, met).where(fits)
    return pairs.select(F.least("node", "node_l").alias("a"), F.greatest("node", "node_l").alias("b")).distinct()


def joined_up(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, comp) after ``links`` (a, b): the components of what ``comp`` has connected so far."""
    if comp is None:
        return components(links).select("node", F.col("label").alias("comp"))
    of = lambda side: comp.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}"))
    lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    found = components(lifted.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")))
    moved = comp.join(found.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("label", "comp").alias("comp"))
    new = found.join(comp.select("node"), "node", "left_anti").select("node", F.col("label").alias("comp"))
    return saved(moved.union(new), "minhash-comp")


def node_components(docs: DataFrame, nodes: DataFrame, same: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the nodes that are connected with another.

    nodes: node, n, bands. same: pairs (a, b) connected beforehand.
    """
    rows = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    multi = saved(rows.join(shared, "key"), "minhash-buckets")
    in_buckets = saved(multi.groupBy("node").agg(F.sum("rows").alias("meets")), "minhash-nodes")
    n_nodes = in_buckets.count()
    sets = saved(full_sets(docs, in_buckets), "minhash-sets")
    comp = joined_up(None, same)
    before = math.inf
    for turn in range(ROUNDS + 1):
        of_node = in_buckets.join(comp, "node", "left").select("node", "meets", F.coalesce("comp", "node").alias("comp"))
        labelled = multi.select("key", "node", "n").join(of_node, "node")
        by_comp = labelled.groupBy("key", "comp").agg(F.count("*").alias("rows"))
        per_key = by_comp.groupBy("key").agg(F.sum("rows").alias("rows"), F.sum(F.col("rows") * F.col("rows")).alias("squares"))
        open_keys = saved(per_key.where("rows * rows > squares"), "minhash-open")
        left = open_keys.agg(F.expr("coalesce(sum((rows * rows - squares) / 2), 0)")).first()[0]
        if not left:
            break
        still = saved(labelled.join(open_keys.select("key"), "key", "left_semi"), "minhash-still")
        last = turn == ROUNDS or left <= OPEN_PER_NODE * n_nodes or left > before / 2
        before = left
        if last:
            pairs = prefix_pairs(still.select("node", "comp").distinct(), sets, percent)
        else:
            pairs = star_pairs(still, turn, percent)
        comp = joined_up(comp, linked(saved(pairs, "minhash-pairs"), sets, percent))
        if last:
            break
    return comp


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept.

    Null and empty texts and texts of white space have no shingles and no links. Rows that share a
    doc_id are one document, connected even if their texts differ. A row with a null doc_id has no
    links: component_id null, kept true. An empty table gives an empty result.
    """
    docs = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    sketched = saved(sketches(docs), "minhash-sketches")
    known = sketched.where("n_shingles > 0 and doc_id is not null")
    nodes = known.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    nodes = saved(nodes, "minhash-representatives")
    member = known.select("doc_id", "digest").distinct().join(nodes.select("digest", "node"), "digest")
    same = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.collect_set("node").alias("all"))
    same = same.where("a < b").select("a", F.explode("all").alias("b")).where("a <> b")
    comp = node_components(docs, nodes, same, percent)
    of_digest = nodes.join(comp, "node", "left").select("digest", F.coalesce("comp", "node").alias("component"))
    found = sketched.drop("bands").join(of_digest, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose document stands for its component, all columns as they were."""
    gone = near_duplicates(df, doc_id, text).where("not kept").select(F.col("doc_id").alias(doc_id)).distinct()
    return df.join(gone, doc_id, "left_anti")
