"""Trie of conversation prefixes, built compressed.

Turns are sorted over range partitions; each prefix gets a 128-bit key from a running xor of its turns' hashes
(each hashed with its depth), so a conversation of any length is spread over tasks. Equal keys are one node.
Only the root, branches, ends and leaves are points of the compressed tree, joined by edges on which all
nodes have the same members. Each node belongs to the path of its representative, the member with the
least hash: a path is a stretch of one conversation, and on the way to the root the path changes about log n
times at most, whatever the input. Sums over subtrees are totals of whole paths, added where these paths
hang, and one running sum along each path. In the end unary nodes get their edge's figures and what the edge
has below them (a suffix sum).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scans import PART, ROW, laid_out, running
from millrace.storage import saved

#: Conversations of a block begin with turns of the block's first one: so many blocks' conversations, so many turns less one.
BLOCK, HEADS = 20, 4
#: Conversation ids of a stretch that is rendered at once.
CHUNK = 4096
#: Prefix keys: two lanes of 64 bits.
KEY = ["k1", "k2"]

SHAPE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def head_turns(conv_id: Column) -> Column:
    """Turns that a conversation takes from its block's first one."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def block_head(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def lanes(depth: Column, turn: Column) -> list[Column]:
    """Two hashes of a turn at its depth."""
    return [F.xxhash64(F.lit(lane), depth.cast("bigint"), turn) for lane in (1, 2)]


def turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv_id, turn, role, text, said, words): ``said`` is the digest of role and text."""
    of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    own = df.select(F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), of(role).alias("role"), of(text).alias("text")).where("conv_id is not null")
    return own.select(
        "*",
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
        F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint").alias("words"),
    )


def rebuilt(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(conversations, prefixes): conv_id and length of each; and of each prefix its key, depth, the key before it, words of its last turn and of all.

    The root's prefix, of depth 0, is among them once for each conversation.
    """
    laid = laid_out(turns(df, conv_id, turn, role, text), ["conv_id"], ["turn", "role", "text"], "trie-turns")
    placed = running(laid.drop("turn", "role", "text"), ["conv_id"], {"nth": ("sum", F.lit(1))})
    placed = saved(placed, "trie-placed")
    sizes = placed.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n_own").alias("n_head"))
    convs = sizes.withColumns({"head": block_head(F.col("conv_id")), "h": head_turns(F.col("conv_id"))}).join(heads, "head", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("n_head", F.lit(0))))
    convs = saved(convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n_own") - F.col("h"))), "trie-convs")
    # at most HEADS - 1 turns of a block's first conversation, for at most 2 * BLOCK conversations each
    first = placed.where(F.col("nth") < HEADS).where(F.col("conv_id") % BLOCK == 0).select(F.col("conv_id").alias("head"), F.col("nth").alias("depth"), "said", "words")
    borrowed = convs.where("taken > 0").select("conv_id", "head", "taken", "length").join(first, "head").where("depth <= taken")
    borrowed = borrowed.groupBy("conv_id", "length").agg(F.array_sort(F.collect_list(F.struct("depth", "said", "words"))).alias("turns"))
    xor = lambda lane: F.expr(f"aggregate(slice(turns, 1, depth), 0L, (a, t) -> a ^ xxhash64({lane}, cast(t.depth as bigint), t.said))")
    starts = borrowed.withColumn("depth", F.size("turns")).select("conv_id", xor(1).alias("b1"), xor(2).alias("b2"), F.expr("aggregate(turns, 0L, (a, t) -> a + t.words)").alias("b_words"))
    spread = borrowed.select("conv_id", "length", "turns", F.explode(F.sequence(F.lit(1), F.size("turns"))).alias("depth"))
    heads_of = spread.select(
        "conv_id", F.col("depth").cast("bigint").alias("depth"), "length", xor(1).alias("k1"), xor(2).alias("k2"), F.expr("turns[depth - 1].said").alias("said"),
        F.expr("turns[depth - 1].words").alias("words"), F.expr("aggregate(slice(turns, 1, depth), 0L, (a, t) -> a + t.words)").alias("all_words"),
    )
    # what a conversation's own turns need of it meets them by range partition, so that a long one is no single key
    known = placed.select(PART, "conv_id").distinct().join(convs.select("conv_id", "h", "taken", "length"), "conv_id").join(starts, "conv_id", "left")
    known = known.fillna(0, ["b1", "b2", "b_words"])
    own = placed.join(known, [PART, "conv_id"]).where("nth > h").withColumn("depth", F.col("nth") - F.col("h") + F.col("taken"))
    one, two = lanes(F.col("depth"), F.col("said"))
    own = running(own, ["conv_id"], {"x1": ("xor", one), "x2": ("xor", two), "w": ("sum", F.col("words"))})
    own = own.select("conv_id", "depth", "length", (F.col("x1").bitwiseXOR(F.col("b1"))).alias("k1"), (F.col("x2").bitwiseXOR(F.col("b2"))).alias("k2"), "said", "words", (F.col("w") + F.col("b_words")).alias("all_words"))
    both = heads_of.unionByName(own)
    one, two = lanes(F.col("depth"), F.col("said"))
    zero = F.lit(0).cast("bigint")
    root = convs.select("conv_id", zero.alias("depth"), "length", *[zero.alias(c) for c in ("k1", "k2", "u1", "u2", "words", "all_words")])
    prefixes = both.withColumns({"u1": F.col("k1").bitwiseXOR(one), "u2": F.col("k2").bitwiseXOR(two)}).drop("said").unionByName(root)
    return convs, saved(prefixes, "trie-prefixes")


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """One row for each different prefix: its key, depth, members, path, children, and whether it is a point."""
    found = prefixes.withColumn("path", F.xxhash64("conv_id")).groupBy("depth", *KEY).agg(
        F.min("conv_id").alias("conv_id"), F.min("path").alias("path"), F.count("*").alias("n_convs"), F.count_if(F.col("depth") == F.col("length")).alias("n_ends"),
        *[F.min(c).alias(c) for c in ("u1", "u2", "words", "all_words")],
    )
    found = saved(found, "trie-nodes")
    children = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count("*").alias("n_children"))
    found = found.join(children, ["depth", *KEY], "left").fillna(0, ["n_children"])
    return saved(found.withColumn("point", (F.col("depth") == 0) | (F.col("n_ends") > 0) | (F.col("n_children") != 1)), "trie-marked")


def hangings(nodes: DataFrame, points: DataFrame) -> DataFrame:
    """(path, above, depth) for each path and each path that it hangs from, directly or not: where on that one."""
    start = nodes.groupBy("path").agg(F.min("depth").alias("depth"))
    firsts = start.join(nodes.select("path", "depth", "u1", "u2", (F.col("all_words") - F.col("words")).alias("words_above")), ["path", "depth"]).where("depth > 0")
    places = points.select(F.col("path").alias("above"), F.col("depth").alias("at"), F.col("conv_id").alias("above_conv"), F.col("k1").alias("u1"), F.col("k2").alias("u2"))
    direct = firsts.select("path", (F.col("depth") - 1).alias("at"), "u1", "u2", "words_above").join(places, ["at", "u1", "u2"])
    return saved(direct.select("path", "above", "at", "above_conv", "words_above"), "trie-hanging")


def ancestors(direct: DataFrame) -> DataFrame:
    """(path, above, at) of all paths above each; as many rounds as paths are nested (about log n at most)."""
    step = direct.select("path", "above", "at")
    found = step
    while True:
        higher = direct.select(F.col("path").alias("above"), F.col("above").alias("next"), F.col("at").alias("next_at"))
        step = saved(step.join(higher, "above").select("path", F.col("next").alias("above"), F.col("next_at").alias("at")), "trie-higher")
        if step.isEmpty():
            return found
        found = found.union(step)


def summed(nodes: DataFrame) -> DataFrame:
    """The points with their edge's top, and what their subtrees hold: leaves, and tokens saved below them."""
    points = saved(nodes.where("point"), "trie-points")
    direct = hangings(nodes, points)
    laid = laid_out(points, ["path"], ["depth"], "trie-along")
    higher = running(laid, ["path"], {"up_conv": ("last", F.col("conv_id")), "up_depth": ("last", F.col("depth")), "up_words": ("last", F.col("all_words"))}, before=True)
    higher = higher.join(direct.select("path", "at", "above_conv", "words_above"), "path", "left")
    edged = higher.withColumns(
        {
            "up_conv": F.coalesce("up_conv", "above_conv"),
            "up_depth": F.coalesce("up_depth", "at", F.lit(-1)),
            "leaf": (F.col("n_children") == 0).cast("bigint"),
            "edge": (F.col("n_convs") - 1) * (F.col("all_words") - F.coalesce("up_words", "words_above", F.lit(0))),
        }
    ).drop("at", "above_conv", "words_above", "up_words")
    edged = saved(edged, "trie-edges")
    whole = edged.groupBy("path").agg(F.sum("edge").alias("edges"), F.sum("leaf").alias("leaves"))
    hung = ancestors(direct).join(whole, "path").groupBy(F.col("above").alias("path"), F.col("at").alias("depth")).agg(F.sum("edges").alias("edges"), F.sum("leaves").alias("leaves"))
    held = edged.join(hung, ["path", "depth"], "left").fillna(0, ["edges", "leaves"])
    totals = running(held, ["path"], {"in_edges": ("sum", F.col("edge") + F.col("edges")), "n_leaves": ("sum", F.col("leaf") + F.col("leaves"))}, backwards=True)
    return totals.withColumn("below", F.col("in_edges") - F.col("edge"))


def expanded(nodes: DataFrame, points: DataFrame) -> DataFrame:
    """All nodes: a unary one has its edge's members and leaves, and saves what the edge saves from it down."""
    own = nodes.join(points.select("depth", *KEY, "up_conv", "up_depth", "n_leaves", "below", F.col("all_words").alias("to_words")), ["depth", *KEY], "left")
    carried = ["up_conv", "up_depth", "n_leaves", "below", "to_words"]
    laid = laid_out(saved(own, "trie-own"), ["path"], ["depth"], "trie-expanded")
    # up_conv is null above the root's edge only, whose single node is the root
    found = running(laid, ["path"], {f"e_{c}": ("last", F.col(c)) for c in carried}, backwards=True)
    return found.select(
        "conv_id",
        "depth",
        *KEY,
        F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("e_up_depth") + 1, F.col("e_up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("e_n_leaves").alias("n_leaves"),
        (F.col("e_below") + (F.col("n_convs") - 1) * (F.col("e_to_words") - F.col("all_words") + F.col("words"))).alias("saved_tokens"),
    )


def ends(prefixes: DataFrame) -> DataFrame:
    """(depth, key, ends_sha256) of nodes that conversations end at: digest of their ids, ascending, comma-joined.

    Ids are rendered in stretches of ``CHUNK``; what one task reads of a node that very many conversations
    end at are these stretches, one after another, since a digest is sequential.
    """
    laid = laid_out(saved(prefixes.where("depth = length").select("depth", *KEY, "conv_id"), "trie-ends"), ["depth", *KEY], ["conv_id"], "trie-ends-sorted")
    pieces = laid.groupBy("depth", *KEY, PART, F.expr(f"{ROW} div {CHUNK}").alias("piece")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for *own, ids in zip(*(batch.column(c).to_pylist() for c in ["depth", *KEY, "ids"]), strict=True):
                if own != key:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) >= 1024:
                yield rows(out)
                out = []
        if state:
            out.append((*key, state.hexdigest()))
        if out:
            yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["depth", *KEY, "ends_sha256"])

    order = ["depth", *KEY, PART, "piece"]
    return pieces.repartition("depth", *KEY).sortWithinPartitions(*order).select("depth", *KEY, "ids").mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def nodes(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), then role and text; null roles and texts are empty. Rows without a
    conv_id belong to no conversation and are left out. Rows that repeat are turns of their own, long texts
    are hashed whole, other columns are ignored. An empty table has no conversation, hence no node.
    """
    _, prefixes = rebuilt(df, conv_id, turn, role, text)
    marked = nodes_of(prefixes)
    every = expanded(marked, summed(marked))
    none = hashlib.sha256(b"").hexdigest()
    found = every.join(ends(prefixes), ["depth", *KEY], "left").fillna(none, ["ends_sha256"])
    return found.selectExpr(*[f"cast({name} as {kind}) as {name}" for name, kind in (c.split() for c in SHAPE.split(", "))])
