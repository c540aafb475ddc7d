"""Personal data: plain patterns, and a semi-Markov conditional random field for what they miss.

The patterns' spans always stay. Around every sign of personal data that no pattern explains, candidate
segments are scored by features of the whole span, and dynamic programming over segments of bounded
length chooses boundaries and types together. It slides over the tokens of a window and settles what
no later segment can change, so memory doesn't follow the length of a text. The weights are fitted by
maximum likelihood on windows made from a parameter set of disguises alone.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import by_batch, texts

KINDS = ("email", "ip", "card", "phone")
# The patterns of the four kinds; digits are 0-9 only.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")  # a run of digits is taken whole in any case
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

#: Tokens and code points of a segment at most, code points on each side of a sign.
MAX_TOKENS, MAX_CHARS, REACH = 32, 128, 64
#: What a segment must add to the score before it is taken: errors on clean text cost more than misses.
MARGIN = 1.0

TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]|\s+")
SIGN = re.compile(r"[0-9](?:[^A-Za-z0-9\n]{0,3}[0-9]){6,}|@|[\[({<] ?(?:at|AT) ?[\])}>]|[0-9]{1,3}(?:[\[({<] ?(?:dot|DOT|\.) ?[\])}>][0-9]{1,3}){3}")
AT = re.compile(r" ?[\[({<] ?(?:at|AT) ?[\])}>] ?")
DOT = re.compile(r" ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?")
CUES = {
    "email": {"email", "mail", "e-mail", "contact", "correo", "courriel"}, "ip": {"ip", "host", "server", "address"},
    "card": {"card", "visa", "credit", "karte", "tarjeta", "carte"}, "phone": {"phone", "tel", "call", "mobile", "telefon", "fax"},
}
ALLOWED = {"email": re.compile(r"[A-Za-z0-9._%+@-]+"), "ip": re.compile(r"[0-9.]+"), "card": re.compile(r"[0-9 ./-]+"), "phone": re.compile(r"[0-9 ().+/-]+")}
#: Digits of each kind.
LIMITS = {"email": (0, 40), "ip": (4, 12), "card": (16, 19), "phone": (8, 15)}
N_FEATURES = 12
CUT_LEFT, CUT_RIGHT = re.compile(r"[0-9][ ./()-]{1,2}$"), re.compile(r"[ ./()-]{1,2}[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping: from each @ back over the local part and on over the domain."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            found.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' spans by kind as listed, then start; a match that fails its check is dropped."""
    found = emails(text) if "@" in text else []
    if DIGITS.search(text):
        found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = re.sub(r"[ -]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(DIGITS.findall(m[0])) <= 15]
    return found


def plain_form(kind: str, span: str) -> str:
    """The span without the usual disguises."""
    if kind == "email":
        return DOT.sub(".", AT.sub("@", span))
    return DOT.sub(".", span) if kind == "ip" else span


def well_formed(kind: str, span: str) -> bool:
    if kind == "email":
        return [(0, len(span))] == [(a, b) for _, a, b in emails(span)]
    digits = "".join(DIGITS.findall(span))
    if kind == "ip":
        return bool(IP.fullmatch(span)) and all(len(p) <= 3 and int(p) <= 255 for p in span.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9]([ ./-]?[0-9])+", span))
    return 8 <= len(digits) <= 15 and bool(re.fullmatch(r"(\+|00)[ ]?[0-9][ ().0-9/-]+[0-9]", span))


def possible(kind: str, span: str, digits: int) -> bool:
    """Whether the span can be well formed, by what is looked up at once."""
    low, high = LIMITS[kind]
    if kind == "email":
        return "@" in span or "at" in span or "AT" in span
    if not low <= digits <= high:
        return False
    if kind == "ip":
        return "." in span or "dot" in span or "DOT" in span
    return kind == "card" or span[0] == "+" or span.startswith("00")


def features(kind: str, window: str, start: int, end: int) -> list[float]:
    """What the whole span looks like as ``kind``, and what stands beside it."""
    span = window[start:end]
    plain = plain_form(kind, span)
    digits = len(DIGITS.findall(plain))
    low, high = LIMITS[kind]
    before = re.findall(r"[A-Za-z-]+", window[max(0, start - 24) : start])
    return [
        1.0,
        float(well_formed(kind, plain)),
        float(not ALLOWED[kind].fullmatch(plain)),
        float(not low <= digits <= high),
        float(start > 0 and window[start - 1].isalnum()),
        float(end < len(window) and window[end].isalnum()),
        float(start > 0 and window[start - 1] in "+.-@_/=\"'"),
        float(bool(before) and before[-1].lower() in CUES[kind]),
        float(span.count("(") != span.count(")")),
        math.log1p(len(span)) / 5,  # below 1 for spans of MAX_CHARS
        float(bool(CUT_LEFT.search(window[max(0, start - 3) : start]))),
        float(bool(CUT_RIGHT.match(window, end))),
    ]


def windows(text: str, known: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Stretches around signs in the gaps between ``known`` spans, within those gaps."""
    fixed: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in known):
        if fixed and a < fixed[-1][1]:
            fixed[-1][1] = max(b, fixed[-1][1])
        else:
            fixed.append([a, b])
    gaps = zip([0, *(b for _, b in fixed)], [*(a for a, _ in fixed), len(text)], strict=True)
    out: list[list[int]] = []
    for left, right in gaps:
        for m in SIGN.finditer(text, left, right):  # what a span leaves of a sign counts on its own
            low, high = max(left, m.start() - REACH), min(right, m.end() + REACH)
            if out and low < out[-1][1]:
                out[-1][1] = max(high, out[-1][1])
            else:
                out.append([low, high])
    return [(a, b) for a, b in out]


def digits_before(window: str) -> np.ndarray:
    """For each place of the window how many digits stand before it."""
    points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.concatenate([[0], np.cumsum((points >= 48) & (points <= 57), dtype=np.int32)])


def candidates(window: str, plausible: bool = False) -> Iterator[tuple[int, list[tuple[int, int, int, int, int]]]]:
    """Per end token (from 1): its candidates (first token, end token, start, end, digits), bounded, holding a sign, with clean ends.

    With ``plausible`` those are left out that have more digits than a card and no sign of an email.
    """
    signs = [(m.start(), m.end()) for m in SIGN.finditer(window)]
    marks = [(a, b) for a, b in signs if b - a < 7]  # held whole
    numbers = [(a, b) for a, b in signs if b - a >= 7]  # held in part
    mark_starts, number_ends = [a for a, _ in marks], [b for _, b in numbers]
    digits = digits_before(window).tolist() if len(window) < 4096 else digits_before(window)
    most = LIMITS["card"][1] if plausible and not marks else len(window)
    open_at: deque[tuple[int, int, int]] = deque(maxlen=MAX_TOKENS)  # token, start, least end; the latest first
    for j, m in enumerate(TOKEN.finditer(window), 1):
        start, end = m.span()
        if window[start].isalnum() or window[start] in "+(":
            mark, number = bisect_left(mark_starts, start), bisect_right(number_ends, start)
            least = min([b for _, b in marks[mark : mark + 1]] + [a + 1 for a, _ in numbers[number : number + 1]], default=len(window) + 1)
            open_at.appendleft((j - 1, start, least))
        here = []
        if window[end - 1].isalnum():
            for i, a, least in open_at:
                n = int(digits[end] - digits[a])
                if i < j - MAX_TOKENS or end - a > MAX_CHARS or n > most:
                    break
                if end >= least:
                    here.append((i, j, a, end, n))
        yield j, here


def segments(window: str) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of tokens, and all candidates of a short window."""
    n, found = 0, []
    for n, here in candidates(window):
        found += [x[:4] for x in here[::-1]]
    return n, found


class Field:
    """Weights for each kind and the inference over a window."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros((len(KINDS), N_FEATURES)) if weights is None else weights

    @staticmethod
    def prepared(window: str) -> tuple[int, list, np.ndarray]:
        n, spans = segments(window)
        table = [[features(kind, window, a, b) for kind in KINDS] for _, _, a, b in spans]
        return n, spans, np.array(table, float).reshape(len(spans), len(KINDS), N_FEATURES)

    def scores(self, table: np.ndarray) -> np.ndarray:
        return np.einsum("skf,kf->sk", table, self.weights)

    def only_well_formed(self) -> bool:
        """Whether no segment that isn't well formed can add to the score, whatever else it looks like."""
        rest = np.maximum(self.weights[:, 2:], 0).sum(axis=1)  # every other feature is at most 1, but for the length's
        return bool((self.weights[:, 0] + rest - MARGIN <= 0).all())

    def best(self, window: str) -> list[tuple[str, int, int]]:
        """The best choice of segments: those outside have score 0 a token.

        Best sums and choices are held for the last ``MAX_TOKENS`` tokens; a choice is a linked list of
        segments, shared by all tokens behind it. Segments that can't add to the score aren't scored.
        """
        best: deque[tuple[float, tuple | None]] = deque([(0.0, None)], maxlen=MAX_TOKENS + 1)
        strict = self.only_well_formed()
        for j, spans in candidates(window, strict):
            top = best[-1]
            for i, _, a, b, n in spans:
                span = window[a:b]
                kinds = [k for k in KINDS if possible(k, span, n) and well_formed(k, plain_form(k, span))] if strict else KINDS
                for kind in kinds:
                    own = float(np.dot(features(kind, window, a, b), self.weights[KINDS.index(kind)])) - MARGIN
                    before, chosen = best[i - j]  # the last of the queue ends at token j - 1
                    if before + own > top[0]:
                        top = (before + own, (chosen, kind, a, b))
            best.append(top)
        found, chosen = [], best[-1][1]
        while chosen:
            chosen, k, a, b = chosen
            found.append((k, a, b))
        return found[::-1]

    def expected(self, n: int, spans: list, table: np.ndarray) -> np.ndarray:
        """Expected feature counts of a window: forward and backward sums over all choices of segments."""
        score = self.scores(table)
        total = np.logaddexp.reduce(score, axis=1)
        ahead, after = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        ahead[0] = after[n] = 0.0
        ending, starting = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
        for s, (i, j, _, _) in enumerate(spans):
            ending[j].append(s)
            starting[i].append(s)
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[spans[s][0]] + total[s] for s in ending[j])])
        for i in range(n - 1, -1, -1):
            after[i] = np.logaddexp.reduce([after[i + 1], *(after[spans[s][1]] + total[s] for s in starting[i])])
        sides = np.array([ahead[i] + after[j] for i, j, _, _ in spans]) - ahead[n]
        return np.einsum("sk,skf->kf", np.exp(score + sides[:, None]), table)

    def fit(self, examples: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 50, ridge: float = 0.002) -> Field:
        """Full-batch Adam on the conditional likelihood."""
        ready = []
        for window, gold in examples:
            n, spans, table = self.prepared(window)
            if not spans:
                continue
            at = {(a, b): s for s, (_, _, a, b) in enumerate(spans)}
            want = sum((np.eye(len(KINDS))[KINDS.index(k)][:, None] * table[at[a, b], KINDS.index(k)] for k, a, b in gold if (a, b) in at), np.zeros_like(self.weights))
            ready.append((n, spans, table, want))
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for step in range(1, steps + 1):
            g = ridge * self.weights
            for n, spans, table, want in ready:
                g = g + (self.expected(n, spans, table) - want) / len(ready)
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.weights = self.weights - 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def made_up(count: int, seed: int = 5) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows with one disguised or plain piece of personal data, and look-alikes that are none."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = digits(15)
        last = next(d for d in "0123456789" if luhn(body + d))
        sep = rng.choice([".", "/", " ", "-"])
        return sep.join(re.findall("....", body + last))

    def email() -> str:
        at, dot = rng.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("@", ".")])
        return f"{word()}{rng.choice(['', '.', '_'])}{digits(rng.randint(0, 2))}{at}{word()}{dot}{rng.choice(['com', 'org', 'net'])}".replace("..", ".")

    ip = lambda: rng.choice(["[.]", "(.)", "[dot]", "."]).join(str(rng.randint(0, 255)) for _ in range(4))
    phone = lambda: rng.choice(["00", "+"]) + rng.choice(["1", "49", "33"]) + rng.choice([" ", "/", "-"]) + digits(3) + rng.choice([" ", "/", "-"]) + digits(3) + rng.choice([" ", "-", ""]) + digits(4)
    kinds = {"email": email, "ip": ip, "card": card, "phone": phone}
    decoys = [
        lambda: hashlib.sha1(word().encode()).hexdigest(), lambda: f"{digits(4)}-{digits(2)}-{digits(2)} {digits(2)}:{digits(2)}", lambda: digits(rng.randint(7, 24)),
        lambda: ".".join(digits(rng.randint(3, 5)) for _ in range(4)), lambda: f"{digits(3)}-{digits(4)}", lambda: f"{digits(4)} {digits(4)} {digits(4)} {digits(3)}",
        lambda: f"{digits(1)},{digits(3)},{digits(3)}", lambda: f"{word()} @ {word()}", lambda: f"{word()} (at) {word()}", lambda: f"@{word()}", lambda: " ".join(digits(rng.randint(1, 4)) for _ in range(rng.randint(6, 12))),
    ]
    out = []
    for k in range(count):
        left = " ".join(word() for _ in range(rng.randint(0, 5))) + " "
        right = rng.choice([" ", ". ", ", "]) + " ".join(word() for _ in range(rng.randint(0, 5)))
        if k % 2:
            kind = KINDS[k // 2 % 4]
            piece = kinds[kind]()
            if rng.random() < 0.2:
                left += rng.choice(sorted(CUES[kind])) + " "
            gold = [(kind, len(left), len(left) + len(piece))]
            if rng.random() < 0.35:  # another piece right behind it
                second = rng.choice(KINDS)
                start, piece = len(left) + len(piece) + 1, f"{piece} {(more := kinds[second]())}"
                gold.append((second, start, start + len(more)))
            out.append((left + piece + right, gold))
        else:
            out.append((left + decoys[k // 2 % len(decoys)]() + right, []))
    return out


@lru_cache
def fitted() -> Field:
    """The field fitted on made-up labelled windows alone, so that it is the same for every table, order and file layout."""
    return Field().fit(made_up(400))


def all_spans(text: str, field: Field, base: list[tuple[str, int, int]] | None = None) -> list[tuple[str, int, int]]:
    """The patterns' spans and what the field finds between them, by kind as listed, then start."""
    known = base_spans(text) if base is None else base
    found = list(known)
    for low, high in windows(text, known):
        found += [(k, a + low, b + low) for k, a, b in field.best(text[low:high])]
    return sorted(found, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SHAPE = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """Per row: doc_id, the patterns' counts, base_sha256 and all spans (offsets in code points, end exclusive).

    Null and empty texts have no spans: counts 0, the digest of the empty string, spans empty.
    """
    own = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text")
    model = field or fitted()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in texts(batch):
            base = base_spans(t)
            counts = [sum(1 for s in base if s[0] == k) for k in KINDS]
            rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(all_spans(t, model, base))))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return own.mapInArrow(by_batch(run), SHAPE)
