"""Merkle manifest of a dataset: a tree for each source, a tree over their roots, a proof for each row.

Leaves are hashed where they are read, sorted over range partitions and numbered. Sixteen consecutive nodes
become one. A tree is worked on in aligned blocks of ``LEVELS`` levels: each block gives its top node, the
tops are the nodes of the next layer, and so on (three layers reach 10^10 leaves). Proofs go down again:
within a block the authentication paths come out one after another by fractal traversal, which keeps on each
level the run of nodes that the present leaf needs and grows the run that the next leaves will need, and
the path of the block's top, made on the layer above, is appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scans import laid_out, running
from millrace.storage import saved

#: Nodes of a run, and levels of a block: 4,096 leaves are in a task's memory at once.
ARITY, LEVELS = 16, 3
#: Fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a batch of proofs.
ROWS = 1024

PATH = "array<struct<before: string, after: string>>"
PATH_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
Path = list[tuple[str, str]]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def hashed(fields: list[Column]) -> Column:
    """Digest of values: each ``-`` if null, else its byte count, a colon and the value."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[one(c.cast("string")) for c in fields]), 256)


class Growing:
    """A run of nodes of one level that grows leaf by leaf, and the unfinished runs below it."""

    def __init__(self, level: int):
        self.runs: list[list[str]] = [[] for _ in range(level + 1)]

    def add(self, node: str, level: int = 0) -> None:
        top = len(self.runs) - 1
        self.runs[level].append(node)
        while level < top and len(self.runs[level]) == ARITY:
            node, self.runs[level] = digest("".join(self.runs[level])), []
            level += 1
            self.runs[level].append(node)

    def closed(self) -> list[str]:
        """The run, once no leaf follows."""
        for level, run in enumerate(self.runs[:-1]):
            if run:
                self.runs[level + 1].append(digest("".join(run)))
        return self.runs[-1]


def depth(n: int) -> int:
    """Levels that ``n`` nodes need to become one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def block_levels(block: int, n: int, levels: int = LEVELS) -> int:
    """Levels of a block with ``n`` nodes: those of the whole tree if it has no other block."""
    return depth(n) if block == 0 and n < ARITY**levels else levels


def top(nodes: list[str], levels: int) -> str:
    grown = Growing(levels)
    for node in nodes:
        grown.add(node)
    return grown.closed()[0]


def traversed(nodes: list[str], levels: int) -> Iterator[Path]:
    """Authentication paths of ``nodes``, one after another, each from the lowest level: what stands before and after.

    On each level the existing run serves the present leaf. The desired one, to its right, takes in a leaf
    a step, so it is ready when the existing one has served.
    """
    spans = [ARITY ** (i + 1) for i in range(levels)]

    def grown(level: int, start: int) -> list[str]:
        run = Growing(level)
        for node in nodes[start : start + spans[level]]:
            run.add(node)
        return run.closed()

    existing = [grown(i, 0) for i in range(levels)]
    desired = [Growing(i) for i in range(levels)]
    path: Path = [("", "")] * levels
    for at in range(len(nodes)):
        for i, span in enumerate(spans):
            if at % (span // ARITY):
                break  # this level and those above serve on
            nth, run = at * ARITY // span % ARITY, existing[i]
            path[i] = ("".join(run[:nth]), "".join(run[nth + 1 :]))
        yield list(path)
        for i, span in enumerate(spans):
            if at + span < len(nodes):
                desired[i].add(nodes[at + span])
            if (at + 1) % span == 0:
                existing[i], desired[i] = desired[i].closed(), Growing(i)


def folded(node: str, path: Path) -> str:
    """The root that ``node`` and its path give."""
    for before, after in path:
        node = digest(before + node + after)
    return node


def by_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**levels}"))


def streamed(blocks: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` over the rows of each (tree, block), a generator of columns; a task holds one block at a time."""
    columns = blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[list[tuple]]:
            key, held = None, []
            for batch in batches:
                for i in range(0, batch.num_rows, ROWS):
                    for row in zip(*(c.to_pylist() for c in batch.slice(i, ROWS).select(columns).columns), strict=True):
                        if row[:2] != key and held:
                            yield held
                            held = []
                        key = row[:2]
                        held.append(row)
            if held:
                yield held

        for rows in each():
            yield from fn(rows)

    return blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(run, schema)


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The next layer: (tree, pos, node) of each block's top."""

    def fn(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        tree, block = rows[0][:2]
        found = top([r[3] for r in rows], block_levels(block, len(rows), levels))
        yield pa.RecordBatch.from_arrays([pa.array([tree]), pa.array([block], pa.int64()), pa.array([found])], ["tree", "pos", "node"])

    return streamed(by_block(nodes, levels).select("tree", "block", "pos", "node"), fn, "tree string, pos bigint, node string")


def layers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` (tree, pos, node) and the layers above, up to the one that has a node for each tree."""
    found = [nodes]
    while True:
        found.append(saved(tops(found[-1], levels), "merkle-layer"))
        if found[-1].where("pos > 0").isEmpty():
            return found


def paths(nodes: DataFrame, above: DataFrame, levels: int, payload: list[str], finish: Callable, schema: str) -> DataFrame:
    """What ``finish`` makes of the nodes of each block, given their paths within it and the row of ``above`` for its top.

    ``above`` has (tree, pos, path, subroot, root). finish: gets rows of node and payload, an iterator of whole
    paths, subroot and root, and yields batches.
    """
    more = [f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in nodes.schema.fields if f.name in payload]
    lower = by_block(nodes, levels).selectExpr("tree", "block", "pos", "node", *payload, f"cast(null as {PATH}) as path", "cast(null as string) as subroot", "cast(null as string) as root")
    upper = above.selectExpr("tree", "pos as block", "-1L as pos", "cast(null as string) as node", *more, "path", "subroot", "root")

    def fn(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        (*_, path, subroot, root), own = rows[0], rows[1:]
        rest = [(p["before"], p["after"]) for p in path]
        found = traversed([r[3] for r in own], block_levels(own[0][1], len(own), levels))
        yield from finish([r[3 : 4 + len(payload)] for r in own], (p + rest for p in found), subroot, root)

    return streamed(lower.unionByName(upper), fn, schema)


def as_above(tree_nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Paths of the nodes of a middle layer, as the rows that the layer below needs."""

    def finish(rows: list[tuple], found: Iterator[Path], subroot: str, root: str) -> Iterator[pa.RecordBatch]:
        held = []
        for (_, tree, pos), path in zip(rows, found, strict=True):
            held.append((tree, pos, [{"before": b, "after": a} for b, a in path], subroot, root))
        kinds = [pa.string(), pa.int64(), PATH_TYPE, pa.string(), pa.string()]
        for i in range(0, len(held), 64):
            columns = [pa.array(c, k) for c, k in zip(zip(*held[i : i + 64], strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "pos", "path", "subroot", "root"])

    own = tree_nodes.select("tree", "pos", "node", F.col("tree").alias("own_tree"), F.col("pos").alias("own_pos"))
    shape = f"tree string, pos bigint, path {PATH}, subroot string, root string"
    return saved(paths(own, above, levels, ["own_tree", "own_pos"], finish, shape), "merkle-paths")


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, from 0 in each tree; saved."""
    rows = running(laid_out(nodes, ["tree"], order, "merkle-sorted"), ["tree"], {"pos": ("sum", F.lit(1))}, before=True)
    return saved(rows.select(F.col("pos").cast("bigint").alias("pos"), *nodes.columns), "merkle-nodes")


def proofs(leaves: DataFrame, order: list[str], payload: list[str], finish: Callable, schema: str, levels: int = LEVELS) -> DataFrame:
    """``finish`` over the leaves (tree, node, and columns to order by and to pass on) with their whole paths to the root."""
    nodes = numbered(leaves, order)
    own = layers(nodes, levels)
    subroots = own[-1].select(F.lit("").alias("tree"), "node", F.col("tree").alias("source"))
    over = numbered(saved(subroots, "merkle-subroots"), ["source"])
    upper = layers(over.select("tree", "pos", "node"), levels)
    none = F.expr(f"cast(array() as {PATH})")
    above = upper[-1].select("tree", "pos", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for layer in reversed(upper[:-1]):
        above = as_above(layer, above, levels)
    of_source = over.join(above.drop("tree", "subroot"), "pos")  # a row for each source
    above = of_source.select(F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("node").alias("subroot"), "root")
    for layer in reversed(own[1:-1]):
        above = as_above(layer, above, levels)
    return paths(nodes, above, levels, payload, finish, schema)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "source") -> DataFrame:
    """(tree, doc_id, node, tampered) of each row: its leaf, and the one that it has with its text tampered with.

    ``tree`` is the source behind a sign, so that it orders as the source does, null first. Tampering
    lower-cases A-Z where 5 divides the checksum of doc_id; elsewhere, and for a null doc_id, it is null.
    """
    of = lambda c: F.col(f"`{c}`")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    bent = [F.translate(of(c).cast("string"), upper, upper.lower()) if c == "text" else of(c) for c in fields]
    chosen = F.crc32(of("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), of(by).cast("string")), F.lit("-")).alias("tree"),
        of("doc_id").cast("bigint").alias("doc_id"),
        hashed([of(c) for c in fields]).alias("node"),
        F.when(chosen, hashed(bent)).alias("tampered"),
    )


def authenticated(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "source", levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, path (what stands before and after on each level, from the leaf up), subroot, root."""

    def finish(rows: list[tuple], found: Iterator[Path], subroot: str, root: str) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 64):
            some = rows[i : i + 64]
            made = [[{"before": b, "after": a} for b, a in next(found)] for _ in some]
            columns = [pa.array([r[1] for r in some], pa.int64()), pa.array([r[0] for r in some]), pa.array(made, PATH_TYPE)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([subroot] * len(some)), pa.array([root] * len(some))], ["doc_id", "leaf", "path", "subroot", "root"])

    own = saved(leaves(docs, fields, by), "merkle-leaves")
    return proofs(own, ["doc_id", "node"], ["doc_id"], finish, f"doc_id bigint, leaf string, path {PATH}, subroot string, root string", levels)


def report(docs: DataFrame, fields: tuple[str, ...] = FIELDS, by: str = "source", levels: int = LEVELS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified, with some texts tampered with.

    Rows of a source ascend by doc_id (null first), rows that repeat an id by their leaf; equal rows are
    leaves of their own. Nulls and empty texts have leaves of their own kind, long texts are hashed whole. An
    empty table gives an empty result; other columns are ignored. A lone row of a lone source is the root.
    """

    def finish(rows: list[tuple], found: Iterator[Path], subroot: str, root: str) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), ROWS):
            out = []
            for leaf, doc_id, tampered in rows[i : i + ROWS]:
                path = next(found)
                up = folded(tampered or leaf, path)
                out.append((doc_id, leaf, subroot, root, digest("".join(b + a for b, a in path)), up, up == root))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    own = saved(leaves(docs, fields, by), "merkle-leaves")
    shape = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return proofs(own, ["doc_id", "node"], ["doc_id", "tampered"], finish, shape, levels)
