"""Mixing sources to target weights.

The words of each source form one stream, packed into fixed-length blocks. The slots of every output
shard are dealt to sources by a multinomial draw; slot i of a source takes the block that the source's
pseudorandom permutation gives for i, pass after pass, and blocks are joined by index. ``packed`` gives
the shards themselves, block after block; ``taken`` and ``mixture`` tell what they hold of each document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from millrace.llm.common import by_batch, texts
from millrace.storage import saved

#: Words of a block, times that a source may be repeated, sources at most (their table goes to the driver).
BLOCK_WORDS, REPEATS, MAX_SOURCES = 64, 3, 100_000
#: Slots of an output shard, and cells of the table of draws (shards by sources) at most: beyond it shards grow.
SHARD_SLOTS, MAX_CELLS = 4096, 1 << 22
#: Rows that are numbered together, and groups of such rows at most.
CHUNK_ROWS, MAX_CHUNKS = 512, 65_536
SEED = 20_240_229


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """The total of ``sizes`` shared by weight, none above ``repeats`` times its size.

    What a full source can't take is shared again by weight among the others.
    """
    total, found, full = float(sum(sizes)), [0.0] * len(sizes), set()
    while True:
        left = total - sum(found[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        for i, w in enumerate(weights):
            if i not in full:
                found[i] = left * w / weight
        over = {i for i in range(len(sizes)) if i not in full and found[i] > repeats * sizes[i]}
        if not over:
            return found
        for i in over:
            found[i] = float(repeats * sizes[i])
        full |= over
        if len(full) == len(sizes):
            return found


def drawn(slots: list[int], shards: int, seed: int) -> np.ndarray:
    """Slots of each source in each shard: a multinomial draw for a shard, by what the sources still have."""
    rng, left = np.random.default_rng(seed), np.array(slots, np.int64)
    out = np.zeros((shards, len(slots)), np.int64)
    for k in range(shards):
        here = int(left.sum()) // (shards - k)
        if here:
            took = np.minimum(rng.multinomial(here, left / left.sum()), left)
            for i in np.argsort(-(left - took), kind="stable"):  # what a source hadn't goes to those with most left
                more = min(here - int(took.sum()), int(left[i] - took[i]))
                took[i] += more
            out[k], left = took, left - took
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row the place of ``index`` in a permutation of range(n) that ``key`` chooses.

    Four Feistel rounds over the next even power of two, again and again until the place is below n.
    """
    half = np.array([max(1, math.ceil(math.log2(max(2, int(x))) / 2)) for x in np.unique(n)], np.uint64)
    half = half[np.searchsorted(np.unique(n), n)]
    mask, out, todo = (np.uint64(1) << half) - np.uint64(1), index.astype(np.uint64), np.ones(len(index), bool)
    n = n.astype(np.uint64)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        high, low = out[todo] >> h, out[todo] & m
        for turn in range(4):
            x = (low + k + np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            high, low = low, high ^ ((x ^ (x >> np.uint64(29))) & m)
        out[todo] = high << h | low
        todo[todo] = out[todo] >= n[todo]
    return out.astype(np.int64)


def sized(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``df`` with mix_size (words), mix_hash (of the text) and mix_id (of doc_id and text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [t.encode() for t in texts(batch, text)]
        hashes = [xxhash.xxh3_64_intdigest(t) >> 1 for t in raw]
        docs = batch.column(doc_id).to_pylist()
        added = [
            pa.array([len(t.split()) for t in raw], pa.int64()),
            pa.array(hashes, pa.int64()),
            pa.array([xxhash.xxh3_64_intdigest(f"{d} {h}".encode(), SEED) >> 1 for d, h in zip(docs, hashes, strict=True)], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "mix_size", "mix_hash", "mix_id"])

    more = [T.StructField(c, T.LongType()) for c in ("mix_size", "mix_hash", "mix_id")]
    return df.mapInArrow(by_batch(run), T.StructType([*df.schema.fields, *more]))


class Plan:
    """Sources with their sizes, targets and slots; a table of at most ``MAX_SOURCES`` rows, on the driver."""

    def __init__(self, per_source: list[tuple[str | None, int]], weights: dict | None = None, seed: int = SEED):
        ranked = sorted(per_source, key=lambda r: (r[0] is None, (r[0] or "").encode()))  # UTF-8 sorts as code points do
        self.sources, self.sizes = [r[0] for r in ranked], [int(r[1] or 0) for r in ranked]
        of = lambda i: float(weights[self.sources[i]]) if weights else float(i % 3 + 1)
        self.targets = targets(self.sizes, [of(i) for i in range(len(ranked))]) if ranked else []
        self.blocks = [-(-s // BLOCK_WORDS) for s in self.sizes]
        self.slots = [min(REPEATS * b, round(t * b / s)) if s else 0 for s, t, b in zip(self.sizes, self.targets, self.blocks, strict=True)]
        total = sum(self.slots)
        self.n_shards = max(1, min(-(-total // SHARD_SLOTS), MAX_CELLS // max(1, len(ranked))))
        self.counts = drawn(self.slots, self.n_shards, seed)
        self.seed = seed

    def table(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.sources, range(len(self.sources)), self.sizes, self.targets, strict=True))
        return spark.createDataFrame(rows, "mix_source string, mix_index int, source_size bigint, target double")

    def taken_blocks(self, spark: SparkSession) -> DataFrame:
        """Per slot of the output: shard, place in it, source index, block, and the pass over the source.

        A shard holds of each source the next slots that its draw counts; its places are shuffled, so
        that sources are mixed within it.
        """
        counts = self.counts.reshape(-1)  # shard after shard, source after source
        ends, n = np.cumsum(counts), len(self.sources)
        before = (np.cumsum(self.counts, axis=0) - self.counts).reshape(-1)
        blocks, seed = np.array(self.blocks, np.int64), self.seed
        sizes = self.counts.sum(axis=1)
        starts = np.cumsum(sizes) - sizes

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = batch.column("id").to_numpy()
            cell = np.searchsorted(ends, ids, side="right")
            shard, source = np.divmod(cell, n)
            slot = before[cell] + ids - (ends[cell] - counts[cell])
            turn, place = np.divmod(slot, blocks[source])
            key = (source + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(seed)
            found = permuted(place, blocks[source], key)
            own = (shard + 1).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(seed)
            shuffled = permuted(ids - starts[shard], sizes[shard], own)
            columns = [shard.astype(np.int32), shuffled, source.astype(np.int32), found, turn.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "place", "mix_index", "block", "turn"])

        total = int(ends[-1]) if len(ends) else 0
        return spark.range(total).mapInArrow(by_batch(run), "shard int, place bigint, mix_index int, block bigint, turn int")


def placed(df: DataFrame, narrow: DataFrame, doc_id: str, source: str, plan: Plan) -> DataFrame:
    """Rows of ``df`` with mix_index, mix_row (its number in the chunk) and mix_start (words of the source before it).

    ``df`` and ``narrow`` (source and sizes of the same rows) come from ``sized`` and have mix_chunk.
    """
    known = plan.table(df.sparkSession).withColumnRenamed("mix_source", "plan_source")
    # the driver has made this table: sent to all tasks, it deals the texts once, to join and to number them
    indexed = lambda x: x.join(F.broadcast(known), F.col(source).eqNullSafe(F.col("plan_source"))).drop("plan_source")
    chunks = indexed(narrow).groupBy("mix_index", "mix_chunk").agg(F.sum("mix_size").alias("chunk_size"))
    chunks = chunks.withColumn("chunk_start", F.sum("chunk_size").over(W.Window.partitionBy("mix_index").orderBy("mix_chunk")) - F.col("chunk_size"))
    rows = indexed(df).join(chunks, ["mix_index", "mix_chunk"])
    order = W.Window.partitionBy("mix_index", "mix_chunk").orderBy(doc_id, "mix_size", "mix_hash")
    return rows.withColumns({
        "mix_row": F.row_number().over(order),
        "mix_start": F.col("chunk_start") + F.sum("mix_size").over(order.rowsBetween(W.Window.unboundedPreceding, 0)) - F.col("mix_size"),
    })


ROW = ["mix_index", "mix_chunk", "mix_row"]


def pieces(rows: DataFrame) -> DataFrame:
    """Per row and block that it overlaps: block, first word (in the row) and number of words."""
    first, last = F.expr(f"mix_start div {BLOCK_WORDS}"), F.expr(f"(mix_start + mix_size - 1) div {BLOCK_WORDS}")
    cut = rows.where("mix_size > 0").select(*ROW, "mix_start", "mix_size", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest(F.col("block") * BLOCK_WORDS, F.col("mix_start"))
    end = F.least((F.col("block") + 1) * BLOCK_WORDS, F.col("mix_start") + F.col("mix_size"))
    return cut.select(*ROW, "block", (begin - F.col("mix_start")).alias("first"), (end - begin).alias("words"))


def prepared(df: DataFrame, doc_id: str, text: str, source: str, weights: dict | None, seed: int, keep: list[str]) -> tuple[DataFrame, Plan]:
    """Rows of ``df`` placed in their source's stream, with the columns ``keep``, and the plan of the mix."""
    own = sized(df, doc_id, text).select(*dict.fromkeys([*keep, doc_id, source]), "mix_size", "mix_hash", "mix_id")
    narrow = saved(own.select(*dict.fromkeys([doc_id, source]), "mix_size", "mix_hash", "mix_id"), "mix-sizes")
    per_source = narrow.groupBy(source).agg(F.sum("mix_size"), F.count("*")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    plan = Plan([tuple(r)[:2] for r in per_source], weights, seed)
    n_chunks = min(MAX_CHUNKS, max(1, sum(r[2] for r in per_source) // CHUNK_ROWS))
    chunk = F.pmod("mix_id", F.lit(n_chunks)).cast("int")
    whole = own if text in keep else narrow  # where no text is needed the texts are read once
    rows = placed(whole.withColumn("mix_chunk", chunk), narrow.withColumn("mix_chunk", chunk), doc_id, source, plan)
    return saved(rows.select(*keep, "mix_size", "source_size", "target", "mix_start", *ROW), "mix-rows"), plan


def taken(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: dict | None = None, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, size, source_size, target (its source's), taken, the words that the mix takes of it, and first_shard, the first that holds some (null: none).

    A null text has size 0 and nothing is taken of it; a null source is a source of its own, last in
    order. Rows that repeat each count. More than ``MAX_SOURCES`` sources are an error. An empty table
    gives an empty result.
    """
    narrow = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text", f"cast(`{source}` as string) as source")
    rows, plan = prepared(narrow, "doc_id", "text", "source", weights, seed, ["doc_id"])
    draws = plan.taken_blocks(df.sparkSession).groupBy("mix_index", "block").agg(F.count("*").alias("draws"), F.min("shard").alias("shard"))
    held = pieces(rows).join(draws, ["mix_index", "block"])
    mixed = held.groupBy(*ROW).agg(F.sum(F.col("words") * F.col("draws")).alias("taken"), F.min("shard").alias("first_shard"))
    found = rows.join(mixed, ROW, "left")
    return found.select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_shard")


def packed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: dict | None = None, seed: int = SEED) -> DataFrame:
    """The shards of the mix: shard, place, source, block, turn (pass over the source), n_words and words.

    One row a slot, in order of place within its shard; a block holds the next ``BLOCK_WORDS`` words of
    its source's stream (the last one fewer), parted by spaces. Nulls, repeats and empty tables as in ``taken``.
    """
    own = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text", f"cast(`{source}` as string) as source")
    rows, plan = prepared(own, "doc_id", "text", "source", weights, seed, ["doc_id", "text", "source"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for t, index, start in zip(texts(batch), batch.column("mix_index").to_pylist(), batch.column("mix_start").to_pylist(), strict=True):
            words, at = t.encode().split(), 0
            while at < len(words):
                block, used = divmod(start + at, BLOCK_WORDS)
                part = words[at : at + BLOCK_WORDS - used]
                out.append((index, block, used, len(part), b" ".join(part).decode()))
                at += len(part)
        columns = zip(*out, strict=True) if out else [[]] * 5
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["mix_index", "block", "at", "n", "part"])

    parts = rows.select("text", "mix_index", "mix_start").mapInArrow(by_batch(run), "mix_index int, block bigint, at int, n int, part string")
    # at most BLOCK_WORDS parts a block
    blocks = parts.groupBy("mix_index", "block").agg(F.sum("n").cast("int").alias("n_words"), F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
    slots = plan.taken_blocks(df.sparkSession).join(blocks, ["mix_index", "block"])
    named = slots.join(plan.table(df.sparkSession).select("mix_index", F.col("mix_source").alias("source")), "mix_index")
    found = named.select("shard", "place", "source", "block", "turn", "n_words", F.array_join("parts.part", " ").alias("words"))
    return found.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")


def mixture(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: dict | None = None, seed: int = SEED) -> DataFrame:
    """The mix as rows of ``df``: for each pass over a source, each row's words in the blocks drawn in that pass.

    Runs of neighbouring blocks keep the text between their words; separate runs are joined by a line
    end. Other columns stay as they were. A row of which a pass takes nothing isn't in that pass.
    """
    names = [f"c{k}" for k in range(len(df.columns))]
    at = {k: names[df.columns.index(c)] for k, c in (("doc", doc_id), ("text", text), ("source", source))}
    rows, plan = prepared(df.toDF(*names), at["doc"], at["text"], at["source"], weights, seed, names)
    blocks = plan.taken_blocks(df.sparkSession).select("mix_index", "block", "turn")
    drawn_pieces = pieces(rows).join(blocks, ["mix_index", "block"])
    runs = drawn_pieces.groupBy(*ROW, "turn").agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("mix_runs"))
    found = rows.join(runs, ROW)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [cut_words(t, r) for t, r in zip(texts(batch, at["text"]), batch.column("mix_runs").to_pylist(), strict=True)]
        columns = [pa.array(new, pa.string()) if n == at["text"] else batch.column(n) for n in names]
        return pa.RecordBatch.from_arrays(columns, names)

    schema = rows.select(*names).schema
    return found.select(*names, "mix_runs").mapInArrow(by_batch(run), schema).toDF(*df.columns)


def cut_words(text: str, runs: list[dict]) -> str:
    """The stretches of ``text`` from word ``first`` on, ``words`` long, neighbouring ones as one."""
    raw = text.encode()
    starts, ends, place = [], [], 0
    for word in raw.split():
        place = raw.index(word, place)
        starts.append(place)
        place += len(word)
        ends.append(place)
    spans: list[list[int]] = []
    for r in runs:
        if spans and spans[-1][1] == r["first"]:
            spans[-1][1] += r["words"]
        else:
            spans.append([r["first"], r["first"] + r["words"]])
    whole = lambda a, b: raw[0 if a == 0 else starts[a] : len(raw) if b == len(starts) else ends[b - 1]]
    return b"\n".join(whole(a, b) for a, b in spans).decode()
