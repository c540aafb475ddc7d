"""Packing documents into token windows by the sum of squares of the fill levels.

A level array counts the partly filled windows of each fill. A document goes to the level where the sum of
the squared counts comes out least, so that no level gathers windows that nothing fits. What is longer than
a window is cut into full ones first. The number of open windows is bounded: beyond the bound a document is
cut to fill the fullest one. At the end of a partition the windows left open are poured together, fullest
first, and what remains becomes windows whose sizes are powers of two, which need no padding.

Each partition of the input packs its own rows, so nothing is shuffled and a lost task is simply run again.
"""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import byte_letters
from millrace.llm.common import SLICE_BYTES, texts

#: Tokens of a window, and the id behind each document.
WINDOW, END_ID = 2048, 1
#: Windows of a partition that are open at once; their tokens are held, 8 MB at most.
OPEN = 1024
#: Words and stems that a worker remembers (twice as many at most), and the length beyond which it remembers none.
MEMO, LONG_WORD = 300_000, 64
#: Code points of a text that are parted into words at once.
STRETCH = 1 << 20
#: Rows of a partition number its windows from here on.
SHIFT = 33

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
BLANK = re.compile("[ \n]")
MARKS = string.punctuation


def narrow(text: str) -> bool:
    """Whether no character is beyond U+00FF."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Words:
    """Ids of texts by a tokenizer file whose pre-tokens never span white space: word by word, remembered.

    A word of letters up to U+00FF, perhaps with marks behind it, is its stem and the marks: the file's
    normaliser only lower-cases it, letter by letter, and its pattern parts it there, so the merge model can
    be asked alone. Whole texts of such characters are lower-cased at once.
    When ``MEMO`` entries are held, those not met again since the last time are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.merges = Tokenizer(self.whole.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocab = self.whole.get_vocab()
        self.is_end = np.zeros(max(vocab.values()) + 1, bool)  # a word's last token bears the format's suffix, no other does
        self.is_end[[i for token, i in vocab.items() if token.endswith(self.whole.model.end_of_word_suffix)]] = True
        letters = {byte: letter for letter, byte in byte_letters().items()}
        self.spelled = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.words: tuple[dict, dict] = {}, {}
        self.stems: tuple[dict, dict] = {}, {}
        self.marks: dict[str, bytes] = {}

    def of_stems(self, stems: set[str]) -> None:
        known, old = self.stems
        new = []
        for s in stems:
            if s not in known:
                if s in old:
                    known[s] = old[s]
                else:
                    new.append(s)
        if not new:
            return
        spelled = [s if s.isascii() else s.translate(self.spelled) for s in new]
        found = np.array(self.merges.encode_batch_fast([" ".join(spelled)], add_special_tokens=False)[0].ids, "<u4")
        ids, start = found.tobytes(), 0
        ends = (np.flatnonzero(self.is_end[found]) + 1) * 4
        for s, end in zip(new, ends.tolist(), strict=True):
            known[s] = ids[start:end]
            start = end

    def learn(self, words: set[str]) -> None:
        known, old = self.words
        plain, odd = [], []
        for w in words:
            if w in old:
                known[w] = old[w]
                continue
            stem = w if w.isalpha() else w.rstrip(MARKS)
            if stem.isalpha() and len(w) < len(stem) + 5 and narrow(stem):
                plain.append((w, stem.lower(), w[len(stem) :]))
            else:
                odd.append(w)
        if odd:
            found = self.whole.encode_batch_fast(odd, add_special_tokens=False)
            known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(odd, found, strict=True))
        if plain:
            self.of_stems({s for _, s, _ in plain})
            stems, marks = self.stems[0], self.marks
            for m in {m for _, _, m in plain} - marks.keys():
                marks[m] = np.array(self.whole.encode(m, add_special_tokens=False).ids, "<u4").tobytes()
            known.update([(w, stems[s] + marks[m] if m else stems[s]) for w, s, m in plain])

    def encode(self, text: str) -> bytes:
        """Ids of the whole text, four bytes each, the lowest first."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts are worked on together up to ``STRETCH`` code points, longer ones in stretches."""
        parts: list[tuple[int, str]] = []
        for i, text in enumerate(texts):
            if "<|" not in text and narrow(text):  # the file's own tokens count in their own case only
                text = text.lower()
            at = 0
            while len(text) - at > STRETCH and (cut := BLANK.search(text, at + STRETCH)):
                parts.append((i, text[at : cut.start()]))
                at = cut.end()
            parts.append((i, text[at:]))
        out: list[list[bytes]] = [[] for _ in texts]
        while parts:
            n = size = 0
            while n < len(parts) and (not n or size + len(parts[n][1]) <= STRETCH):
                size += len(parts[n][1])
                n += 1
            some, parts = parts[:n], parts[n:]
            split = [t.replace("\n", " ").split(" ") for _, t in some]
            new = set(filterfalse(self.words[0].__contains__, chain.from_iterable(split)))
            if new:
                self.learn(new)
            known = self.words[0]
            for (i, _), words in zip(some, split, strict=True):
                out[i].append(b"".join(map(known.__getitem__, words)))
            for w in new:
                if len(w) > LONG_WORD:
                    del known[w]
                    self.stems[0].pop(w.lower(), None)
            self.words, self.stems = forgetting(self.words), forgetting(self.stems)
            if len(self.marks) > MEMO:
                self.marks = {}
        return [b"".join(x) for x in out]


def forgetting(known: tuple[dict, dict]) -> tuple[dict, dict]:
    return ({}, known[0]) if len(known[0]) > MEMO else known


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Words:
    """Loaded once in each worker."""
    return Words(path)


class Piece:
    """A stretch of one document: ``length`` of its ids from ``start`` on."""

    __slots__ = ("doc", "ids", "start", "length")

    def __init__(self, doc: object, ids: bytes, start: int, length: int):
        self.doc, self.ids, self.start, self.length = doc, ids, start, length

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.ids, self.start, length), Piece(self.doc, self.ids, self.start + length, self.length - length)


class Packer:
    """Windows of one partition; ``done`` gets each finished one, a list of pieces."""

    def __init__(self, size: int = WINDOW, most_open: int = OPEN):
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, np.int64)
        self.levels: list[list[list[Piece]]] = [[] for _ in range(size + 1)]
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def best_level(self, length: int) -> int:
        """The level (0: a new window) for which the sum of squared counts comes out least; ties go to the fullest."""
        n, size = self.counts, self.size
        change = 2 * n[length : size + 1] - 2 * n[: size + 1 - length] + 2  # by level, from 0
        change[0] = 2 * n[length] + 1
        change[size - length] -= 1 if length < size else 0  # a full window is in no count
        held = n[: size + 1 - length] > 0
        held[0] = True
        change[~held] = np.iinfo(np.int64).max
        return size - length - int(change[::-1].argmin())

    def put(self, piece: Piece, level: int) -> None:
        """``piece`` into a window filled to ``level``."""
        if level:
            window = self.levels[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        filled = level + piece.length
        if filled == self.size:
            self.done.append(window)
        else:
            self.levels[filled].append(window)
            self.counts[filled] += 1
            self.n_open += 1

    def add(self, doc: object, ids: bytes) -> None:
        """All ids of a document (four bytes each)."""
        rest = Piece(doc, ids, 0, len(ids) // 4)
        while rest.length >= self.size:
            full, rest = rest.cut(self.size)
            self.done.append([full])
        while rest.length:
            level = self.best_level(rest.length)
            if level or self.n_open < self.most_open:
                self.put(rest, level)
                return
            level = int(np.flatnonzero(self.counts)[-1])
            part, rest = rest.cut(min(rest.length, self.size - level))
            self.put(part, level)

    def finish(self) -> None:
        """Pours the open windows together, the emptiest into the fullest; what is left is parted at powers of two."""
        left = [window for level in self.levels for window in level]  # by fill, the emptiest first
        self.counts[:], self.n_open = 0, 0
        self.levels = [[] for _ in range(self.size + 1)]
        loose: list[Piece] = []  # of windows that have been taken apart, to be used from the end
        while left:
            window = left.pop()
            room = self.size - sum(p.length for p in window)
            while room and (loose or left):
                loose = loose or left.pop(0)[::-1]
                piece = loose.pop()
                if piece.length > room:
                    piece, rest = piece.cut(room)
                    loose.append(rest)
                window.append(piece)
                room -= piece.length
            if room:
                loose = window[::-1]
            else:
                self.done.append(window)
        while loose:
            filled = sum(p.length for p in loose)
            window, want = [], 1 << (filled.bit_length() - 1)
            while want:
                piece = loose.pop()
                if piece.length > want:
                    piece, rest = piece.cut(want)
                    loose.append(rest)
                window.append(piece)
                want -= piece.length
            self.done.append(window)


def pack(df: DataFrame, path: str, size: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, start and length in its document's ids, doc_tokens, sequence_id, offset there, and ids (little-endian, 32 bits each).

    A document is its text's ids and ``end_id``; a null or empty text is ``end_id`` alone. A null doc_id stays
    null, rows that repeat are packed as often. An empty table gives an empty result; other columns are ignored.
    A very long text is parted at white space before it is encoded, which changes no id. A sequence holds
    ``size`` tokens, or a smaller power of two at the end of a partition. One long word is encoded at once.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = vocabulary(path), Packer(size)
        number = TaskContext.get().partitionId() << SHIFT

        def rows(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number
            while len(packer.done) > least:
                some, packer.done = packer.done[: SLICE_BYTES // (4 * size) + 1], packer.done[SLICE_BYTES // (4 * size) + 1 :]
                out = []
                for window in some:
                    offset = 0
                    for p in window:
                        out.append((p.doc, p.start, p.length, len(p.ids) // 4, number, offset, p.ids[4 * p.start : 4 * (p.start + p.length)]))
                        offset += p.length
                    number += 1
                kinds = [pa.int64()] * 6 + [pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                for doc, ids in zip(part.column("doc_id").to_pylist(), own.encode_all(texts(part)), strict=True):
                    packer.add(doc, ids + end)
                yield from rows(256)
        packer.finish()
        yield from rows(0)

    return df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text").mapInArrow(run, PIECES)


def sequences(pieces: DataFrame, size: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """Per sequence: sequence_id, ids (array of int, padded to ``size`` unless their number is a power of two), n_tokens, docs.

    ``docs`` lists doc_id, offset and length of each piece, which is what a mask between documents needs.
    """
    own = pieces.select("sequence_id", F.struct("offset", "doc_id", "length", "ids").alias("piece"))
    each = own.groupBy("sequence_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    hexed = F.array_join(F.transform("pieces", lambda p: F.hex(p.ids)), "")
    # eight hexadecimal digits an id, the lowest byte first
    number = "transform(sequence(1, length(h), 8), i -> cast(conv(concat(substr(h, i + 6, 2), substr(h, i + 4, 2), substr(h, i + 2, 2), substr(h, i, 2)), 16, 10) as int))"
    each = each.withColumn("h", hexed).withColumn("real", F.expr(number)).withColumn("n_tokens", F.size("real"))
    padding = F.when(F.expr("n_tokens & (n_tokens - 1)") == 0, 0).otherwise(F.greatest(F.lit(0), F.lit(size) - F.col("n_tokens")))
    return each.select(
        "sequence_id",
        F.concat("real", F.array_repeat(F.lit(pad_id), padding.cast("int"))).alias("ids"),
        "n_tokens",
        F.transform("pieces", lambda p: F.struct(p.doc_id.alias("doc_id"), p.offset.alias("offset"), p.length.alias("length"))).alias("docs"),
    )


def report(df: DataFrame, path: str, size: int = WINDOW) -> DataFrame:
    """The pieces of ``pack`` with the checksum of their ids in place of the ids."""
    own = pack(df, path, size)
    return own.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
