"""BPE encoding and decoding with forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never lie inside a merged token, so a cut
between its two bytes is certain. A text is first cut before single spaces (no token has a space
after another character), then each pre-token at its remaining forced boundaries. The fragments are
encoded independently, remembered since they repeat, and their ids concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import by_batch, texts

# The pre-token pattern of the byte-level vocabulary format.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes that the format writes as themselves; the others follow from code point 256 on.
PRINTABLE = ((33, 126), (161, 172), (174, 255))

#: Entries of each of the two generations of results that a worker remembers.
MEMO = 250_000
#: Bytes of a fragment from which pairs wait in a heap.
LONG = 400
#: A single space between two characters that aren't white space: pre-tokens always part before it.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


#: A word of plain Latin letters and the one mark that may follow it: no pattern is needed to part them.
PLAIN = re.compile(r"( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([.,!?;:]?)").fullmatch

NEVER, FORCED = 1 << 62, 1 << 63


class Memo(dict):
    """Results by text. When ``MEMO`` are held, those not asked for since the last time are forgotten."""

    def __init__(self, make: Callable[[str], tuple]):
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> tuple:
        found = self.old.get(key) or self.make(key)
        if len(key) < 64:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


def byte_letters() -> dict[str, int]:
    """The vocabulary file's letter for each byte."""
    letters, spare = {}, 256
    for byte in range(256):
        if any(low <= byte <= high for low, high in PRINTABLE):
            letters[chr(byte)] = byte
        else:
            letters[chr(spare)] = byte
            spare += 1
    return letters


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes = {i: as_bytes(t) for t, i in vocab.items() if t not in self.special}
        inside = {a << 8 | b for t in self.token_bytes.values() for a, b in zip(t, t[1:], strict=False)}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.bytes_of = [self.token_bytes.get(i, b"") for i in range(max(self.token_bytes) + 1)]
        self.lone_space = not any(b << 8 | 32 in inside for b in range(256) if not chr(b).isspace())
        self.same = list(range(len(self.bytes_of)))  # one object for each id: what is remembered holds no others
        self.names = list(map(str, self.same))
        self.single = [vocab[c] for c in sorted(letters, key=letters.get)]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]
        merge_of = lambda k: self.merges.get(self.single[k >> 8] << 32 | self.single[k & 255], NEVER)
        self.byte_ranks = [merge_of(k) if k in inside else FORCED for k in range(65536)]
        self.find = regex.compile(PRETOKEN).findall
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pretokens = Memo(self.pretoken)
        self.pieces = Memo(lambda piece: self.piece(" " + piece))

    def pretoken(self, text: str) -> tuple:
        """Ids of one pre-token: cut at every forced boundary, its fragments encoded one by one."""
        raw = text.encode()
        ids, table = [self.single[b] for b in raw], self.byte_ranks
        ranks = [table[a << 8 | b] for a, b in zip(raw, raw[1:], strict=False)]
        if FORCED not in ranks:
            return tuple([self.same[i] for i in self.merge(ids, ranks)])
        out, start = (), 0
        for end in [i + 1 for i, rank in enumerate(ranks) if rank == FORCED] + [len(ids)]:
            out += self.merge(ids[start:end], ranks[start : end - 1])
            start = end
        return tuple([self.same[i] for i in out])

    def merge(self, ids: list[int], ranks: list[int]) -> tuple:
        """Ids of one fragment: the lowest-ranked pair merges first, the leftmost of equals.

        ranks: for each neighbouring pair its rank and the id that it merges to, or ``NEVER``.
        """
        if len(ids) > LONG:
            return self.merge_long(ids)
        get = self.merges.get
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            ids[i] = best & 0xFFFFFFFF
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], NEVER)
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], NEVER)
        return tuple(ids)

    def merge_long(self, ids: list[int]) -> tuple:
        """The same in n log n steps: links between neighbours and a heap of pairs."""
        n, merges = len(ids), self.merges
        after, before, waiting = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < n:
                a, b = ids[left], ids[after[left]]
                if (found := merges.get(a << 32 | b)) is not None:
                    heapq.heappush(waiting, (found, left, a, b))

        for i in range(n - 1):
            offer(i)
        while waiting:
            found, left, a, b = heapq.heappop(waiting)
            right = after[left] if ids[left] == a else n
            if right >= n or ids[right] != b:
                continue
            ids[left], ids[right], after[left] = found & 0xFFFFFFFF, -1, after[right]
            if after[left] < n:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return tuple(i for i in ids if i >= 0)

    def piece(self, text: str) -> tuple:
        """Ids of a stretch that starts and ends at a boundary between pre-tokens."""
        if plain := PLAIN(text):
            ids = self.pretokens[plain[1]]
            return ids + self.pretokens[plain[2]] if plain[2] else ids
        return tuple(chain.from_iterable([self.pretokens[p] for p in self.find(text)]))

    def encoded_pieces(self, text: str) -> list[tuple]:
        """Ids of the stretches of ``text`` between certain boundaries."""
        out = []
        for k, part in enumerate(self.parts.split(text) if self.parts else [text]):
            if k % 2:
                out.append((self.special[part],))
            elif part:
                first, *rest = LONE_SPACE.split(part) if self.lone_space else [part]
                out.append(self.piece(first))
                known = self.pieces
                out += [known[p] for p in rest]
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.encoded_pieces(text)))

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; ids that are not in the vocabulary are passed over, as the format's decoder does."""
        own = self.bytes_of
        if ids and not 0 <= min(ids) <= max(ids) < len(own):
            ids = [i for i in ids if 0 <= i < len(own)]
        return b"".join([own[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> ByteBpe:
    """Loaded once in each worker."""
    return ByteBpe(path)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with column ``ids`` (array of int): the whole text encoded.

    Null and empty texts give an empty array. A column that already bears the name is replaced.
    """
    keep = [c for c in df.columns if c != ids]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = vocabulary(path)
        out = pa.array([own.encode(t) for t in texts(batch, text)], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), out], [*keep, ids])

    return df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text])]).mapInArrow(by_batch(run), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with column ``text`` decoded from ``ids``; null ids give an empty text."""
    keep = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(text, T.StringType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = vocabulary(path)
        out = pa.array([own.decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), out], [*keep, text])

    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(by_batch(run), schema)


def digests(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of an encode and decode of the whole text.

    Null and empty texts have no tokens. Rows that repeat stay; a null doc_id stays null.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = vocabulary(path)
        counts, of_ids, of_text = [], [], []
        for t in texts(batch, "text"):
            ids = own.encode(t)
            counts.append(len(ids))
            of_ids.append(hashlib.sha256(",".join([own.names[i] for i in ids]).encode()).hexdigest())
            of_text.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text").mapInArrow(
        by_batch(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
