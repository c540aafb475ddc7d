"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a bounded sample, drawn by a hash over all rows. The
next rule is the one with most rejections per cost among the documents that the rules before it leave,
with what they have measured at hand; a document that one rule rejects is not shown to the next. The
order changes only the work: a document is kept if no rule rejects it.
"""

from __future__ import annotations

import math
import re
import time
from collections import Counter
from collections.abc import Callable
from copy import copy
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import by_batch, texts

LATIN = re.compile("[A-Za-z\u00AA\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F\u1E00-\u1EFF]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")

#: Sampled documents, and the code points above which one isn't sampled, for the estimates.
SAMPLE_ROWS, SAMPLE_CHARS = 400, 65_536


class Measures:
    """What the rules look at in one text, each measured when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes part at exactly [\x20\x09-\x0D]

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(SYMBOLS.findall(self.text))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [x for x in self.text.encode().split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    @cached_property
    def n_full_lines(self) -> int:
        return sum(1 for x in self.text.encode().split(b"\n") if x.strip())

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that stand in a 3-word window found twice or more."""
        words = self.words
        seen: dict[tuple, int] = {}
        repeated: set[int] = set()
        for i, window in enumerate(zip(words, words[1:], words[2:], strict=False)):
            first = seen.setdefault(window, i)
            if first != i:
                repeated.update((first, first + 1, first + 2, i, i + 1, i + 2))
        return len(repeated)

    @cached_property
    def n_top_word(self) -> int:
        """How often the most frequent word stands in the text."""
        return max(Counter(self.words).values(), default=0)

    @cached_property
    def entropy(self) -> float:
        """Bits a character that the text's characters take on average."""
        n = len(self.text)
        return -sum(c / n * math.log2(c / n) for c in Counter(self.text).values())

    @cached_property
    def letters(self) -> tuple[int, int]:
        """Latin letters and others."""
        rest = LATIN.sub("", self.text)
        return len(self.text) - len(rest), 0 if rest.isascii() else sum(map(str.isalpha, rest))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


BASE = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repetition", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
EXTRA = (
    Rule("symbols", lambda m: 100 * m.n_symbols > 30 * m.n_words),
    Rule("word_length", lambda m: m.n_words > 0 and not 2 * m.n_words <= m.word_chars <= 15 * m.n_words),
    Rule("duplicate_lines", lambda m: 100 * m.n_dup_lines > 50 * m.n_full_lines),
)
RULES = BASE + EXTRA
#: Rules that look at the text once more: nothing that a report holds helps them, so they come last and see few texts.
CONTENT = (
    Rule("one_word", lambda m: 100 * m.n_top_word > 30 * m.n_words),
    Rule("entropy", lambda m: m.entropy < 2),
    Rule("mixed_scripts", lambda m: 100 * min(m.letters) > 40 * sum(m.letters)),
)
CASCADE = RULES + CONTENT
#: Measures that a report has for every row whatever the rules ask.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def timed(rule: Rule, measures: list[Measures]) -> tuple[float, list[bool]]:
    """Seconds a text and the verdicts of ``rule``, on copies that know what has been measured already."""
    own = [copy(m) for m in measures]
    began = time.perf_counter()
    verdicts = [rule.rejects(m) for m in own]
    return (time.perf_counter() - began) / max(1, len(own)), verdicts


def ordered(sample: list[str], rules: tuple[Rule, ...] = RULES, cost: Callable[[Rule, list[Measures]], tuple[float, list[bool]]] = timed, known: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """``rules`` in the order of rejection per cost on what is left of ``sample``, ties by cost then name.

    The measures ``known`` are taken in any case, so they cost a rule nothing.
    """
    left, rest, out = [Measures(t) for t in sample], list(rules), []
    for m in left:
        for name in known:
            getattr(m, name)
    while rest and left:
        found = {r.name: cost(r, left) for r in rest}
        rate = lambda r: sum(found[r.name][1]) / len(left) / max(found[r.name][0], 1e-9)  # noqa: B023, E731
        best = min(rest, key=lambda r: (-rate(r), found[r.name][0], r.name))  # noqa: B023
        out.append(best)
        rest.remove(best)
        left = [m for m in left if not best.rejects(m)]
    return (*out, *rest)


def sampled(df: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """At most ``rows`` texts, those of the smallest hashes over all rows, whatever their order or files.

    Only rows under a bound on the hash are sorted, so that what tasks send doesn't grow with their number:
    about twice as many rows as are wanted lie under the first, and it is raised where that was too few.
    """
    own = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    short = df.where(F.length(F.col(f"`{text}`")) <= SAMPLE_CHARS)
    hashed = short.select(F.xxhash64(*own).alias("h"), F.col(f"`{text}`").alias("t"))
    share = 2 * rows / max(1, df.count())
    while True:
        below = hashed if share >= 1 else hashed.where(F.col("h") < -(2**63) + int(share * 2**64))
        found = below.orderBy("h", "t").limit(rows).collect()
        if len(found) == rows or share >= 1:
            return [r["t"] for r in found]
        share *= 8


def sampled_order(df: DataFrame, rules: tuple[Rule, ...] = CASCADE, text: str = "text", known: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """The order for ``df`` from a sample of at most ``SAMPLE_ROWS`` texts (an empty table: as given)."""
    return ordered(sampled(df, text), rules, known=known)


def rules_run(text: str, rules: tuple[Rule, ...]) -> int:
    """How many rules look at the text: up to the first that rejects it."""
    measures = Measures(text)
    return next((i for i, r in enumerate(rules, 1) if r.rejects(measures)), len(rules))


def rejected_by(text: str, rules: tuple[Rule, ...]) -> str | None:
    """Name of the first rule in the given order that rejects the text, None if none does."""
    measures = Measures(text)
    return next((r.name for r in rules if r.rejects(measures)), None)


def keep(df: DataFrame, rules: tuple[Rule, ...] = CASCADE, text: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects, all columns as they were.

    A null text has no words, so rules on word counts reject it. Rows that repeat are judged alike.
    """
    order = sampled_order(df, rules, text)
    if not df.columns:
        return df

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([rejected_by(t, order) is None for t in texts(batch, text)], pa.bool_()))

    return df.mapInArrow(by_batch(run), df.schema)


REPORT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, rejected_by string"


def report(df: DataFrame, rules: tuple[Rule, ...] = CASCADE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the base measures, base_failed, kept, and the rule of the cascade that rejected the row.

    ``rejected_by`` depends on the estimated order, the other columns don't. Null and empty texts
    have no words: all counts 0, base_failed true. The measures reported are taken for every row; of the
    rules each row runs those up to the first that rejects it, so the dearer ones see what is left.
    """
    order = sampled_order(df, rules, text, REPORTED)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for t in texts(batch):
            m = Measures(t)
            base = m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words  # BASE, of which all are reported
            by = next((r.name for r in order if r.rejects(m)), None)
            rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, base, not base and by is None, by))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    return df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text").mapInArrow(by_batch(run), REPORT)
