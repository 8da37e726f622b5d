"""Personal data: exact patterns, and a semi-Markov conditional random field that adds to them.

The field scores whole candidate spans (shape, digits, checksum, neighbours) and picks boundaries
and kinds together by dynamic programming over spans of bounded length. It is trained here, on
islands of a bounded sample of documents: what the patterns find is labelled with its kind, and
so are copies of it in other notations; everything else is outside.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplog.llm.common import boxed, sampled

KINDS = ("email", "ip", "card", "phone")
#: Documents with a digit or an at sign to learn from at most; the sample goes by a hash.
SAMPLE_ROWS = 500
EPOCHS = 3
RATE = 0.3
#: Tokens in an entity at most, and size of the hashed weight vector of a kind.
MAX_TOKENS = 20
BITS = 14
#: Span scores need this much over all outside, in log odds, to be added.
MARGIN = 1.0

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of digits and dots ends with its last digits, so none begins inside a run of digits.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HIT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\W_]+|[\W_]")
NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Of the pattern local@domain, leftmost first: the longest local part before each domain
    that no earlier match holds. Linear, where the plain pattern tries every start."""
    end = before = 0
    for m in AT_DOMAIN.finditer(text):
        at = m.start()
        floor = max(end, before)
        local = text[floor:at]
        start = floor + len(local.rstrip(LOCAL))
        if start < at:
            yield start, m.end()
            end = m.end()
        before = at + 1


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their checks, by start, then kind."""
    found: list[Span] = []
    if "@" in text:
        found += [("email", a, b) for a, b in emails(text)]
    if not HIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group()) if m.end() - m.start() >= 14 else ""
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", *m.span()))
    return ordered(found)


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring words that have a digit or an at sign, with the words beside."""
    start = end = -1
    for m in HIT.finditer(text):
        if m.start() < end:
            continue
        left = max(text.rfind(c, max(end, 0), m.start()) for c in " \n\t\r\v\f") + 1
        if left == 0 and end > 0:
            left = end
        rights = [p for c in " \n\t\r\v\f" if (p := text.find(c, m.end(), m.end() + 400)) >= 0]
        right = min(rights) if rights else min(len(text), m.end() + 400)
        if start >= 0 and left - end <= 1:
            end = right
            continue
        if start >= 0:
            yield start, end
        start, end = left, right
    if start >= 0:
        yield start, end


def shape(span: str) -> str:
    s = re.sub(r"[^\W\d_]+", "a", span)
    return re.sub(r"\s", "_", re.sub(r"[0-9]+", lambda m: str(min(len(m.group()), 5)), s))


def slot(*parts: object) -> int:
    return crc32("|".join(map(str, parts)).encode()) & ((1 << BITS) - 1)


def features(text: str, start: int, end: int) -> list[int]:
    """Hashed features of one whole span."""
    span = text[start:end]
    digits = NOT_DIGIT.sub("", span)
    form = shape(span)
    loose = re.sub(r"[0-9]", "9", form)
    parts = span.split(".")
    octets = len(parts) == 4 and all(p.isdecimal() and len(p) < 4 and int(p) < 256 for p in parts)
    return [
        slot("bias"),
        slot("form", form[:24]),
        slot("loose", re.sub(r"(?:9[ ._-]?)+", "9", loose)[:16]),
        slot("digits", min(len(digits), 20), "a" in form),
        slot("luhn", 13 < len(digits) < 20 and "a" not in form and luhn(digits)),
        slot("octets", octets),
        slot("at", span.count("@"), "." in span.partition("@")[2]),
        slot("marks", "".join(sorted(set(form) - set("a12345_")))),
        slot("left", shape(text[max(0, start - 1) : start])),
        slot("right", shape(text[end : end + 1])),
        slot("ends", form[:1], form[-1:]),
    ]


class Lattice:
    """Candidate spans of one island. A segment outside is one token long."""

    def __init__(self, text: str, start: int, end: int):
        marks = [m.span() for m in TOKEN.finditer(text, start, end)]
        self.starts, self.ends = [a for a, _ in marks], [b for _, b in marks]
        hits = [bool(HIT.search(text, a, b)) for a, b in marks]
        self.into: list[list[tuple[int, list[int]]]] = [[] for _ in range(len(marks) + 1)]
        for i, (a, _) in enumerate(marks):
            if not (text[a].isalnum() or text[a] in "+("):
                continue
            weight = 0
            for j in range(i, min(i + MAX_TOKENS, len(marks))):
                b = marks[j][1]
                if text[marks[j][0]] in "\n\r":
                    break
                weight += sum(c.isdecimal() for c in text[marks[j][0] : b]) if hits[j] else 0
                weight += 4 * (text[marks[j][0]] == "@")
                if weight >= 4 and text[b - 1].isalnum():
                    self.into[j + 1].append((i, features(text, a, b)))

    def __len__(self) -> int:
        return len(self.starts)


class Field:
    """Weights of (kind, feature) and of neighbouring kinds, outside being the last kind."""

    def __init__(self, w: np.ndarray | None = None):
        n = len(KINDS)
        self.size = n << BITS
        self.w = np.zeros(self.size + (n + 1) ** 2) if w is None else w
        self.offsets = (np.arange(n) << BITS)[:, None]

    def turns(self) -> np.ndarray:
        return self.w[self.size :].reshape(len(KINDS) + 1, -1)

    def scores(self, found: list[int]) -> np.ndarray:
        return self.w[self.offsets + np.array(found)].sum(axis=1)

    def forward(self, lattice: Lattice) -> np.ndarray:
        """alpha[j, k]: log sum over the cuts of the first j tokens whose last segment is k."""
        n, out = len(lattice), len(KINDS)
        alpha = np.full((n + 1, out + 1), -np.inf)
        alpha[0, out] = 0.0
        turns = self.turns()
        for j in range(1, n + 1):
            alpha[j, out] = np.logaddexp.reduce(alpha[j - 1] + turns[:, out])
            for i, found in lattice.into[j]:
                before = np.logaddexp.reduce(alpha[i][:, None] + turns[:, :out], axis=0)
                alpha[j, :out] = np.logaddexp(alpha[j, :out], before + self.scores(found))
        return alpha

    def backward(self, lattice: Lattice) -> np.ndarray:
        n, out = len(lattice), len(KINDS)
        beta = np.full((n + 1, out + 1), -np.inf)
        beta[n] = 0.0
        turns = self.turns()
        for j in range(n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], turns[:, out] + beta[j, out])
            for i, found in lattice.into[j]:
                after = np.logaddexp.reduce(
                    turns[:, :out] + self.scores(found) + beta[j, :out], axis=1
                )
                beta[i] = np.logaddexp(beta[i], after)
        return beta

    def gradient(self, lattice: Lattice, gold: dict[tuple[int, int], int]) -> tuple:
        """Coordinates and gradient of the log likelihood: observed less expected counts."""
        out, turns = len(KINDS), self.turns()
        alpha, beta = self.forward(lattice), self.backward(lattice)
        total = np.logaddexp.reduce(alpha[-1])
        at, grad = [], []
        turn = np.zeros((out + 1, out + 1))
        last, j = out, 0
        by_start = {i: (e, k) for (i, e), k in gold.items()}
        while j < len(lattice):
            e, k = by_start.get(j, (j + 1, out))
            turn[last, k] += 1
            last, j = k, e
        for j in range(1, len(lattice) + 1):
            turn[:, out] -= np.exp(alpha[j - 1] + turns[:, out] + beta[j, out] - total)
            for i, found in lattice.into[j]:
                p = np.exp(
                    alpha[i][:, None] + turns[:, :out] + self.scores(found) + beta[j, :out] - total
                )
                turn[:, :out] -= p
                want = np.zeros(out)
                if (i, j) in gold:
                    want[gold[i, j]] = 1
                g = want - p.sum(axis=0)
                at.append((self.offsets + np.array(found)).ravel())
                grad.append(np.repeat(g, len(found)))
        at.append(self.size + np.arange(turn.size))
        grad.append(turn.ravel())
        return np.concatenate(at), np.concatenate(grad)

    def best(self, lattice: Lattice) -> Iterator[tuple[str, int, int]]:
        """Spans of the best cut; an equal score stays outside."""
        into = [[(i, self.scores(found)) for i, found in here] for here in lattice.into]
        for k, i, j in self.cut(into):
            yield KINDS[k], lattice.starts[i], lattice.ends[j - 1]

    def cut(self, into: list[list[tuple[int, np.ndarray]]]) -> Iterator[tuple[int, int, int]]:
        """(kind, first token, end token) of the best cut, last one first; `into` holds the segments
        by their end, with their start and a score for each kind."""
        n, out, turns = len(into) - 1, len(KINDS), self.turns()
        top = np.full((n + 1, out + 1), -np.inf)
        top[0, out] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            came = top[j - 1] + turns[:, out]
            last = int(np.argmax(came))
            top[j, out], back[j, out] = came[last], (j - 1, last)
            for i, scores in into[j]:
                came = top[i][:, None] + turns[:, :out]
                last = np.argmax(came, axis=0)
                score = came.max(axis=0) + scores - MARGIN
                for k in np.flatnonzero(score > top[j, :out]).tolist():
                    top[j, k], back[j, k] = score[k], (i, int(last[k]))
        j, k = n, out if n and top[n, out] >= top[n].max() else int(np.argmax(top[n]))
        while j:
            i, last = back[j, k]
            if k != out:
                yield k, i, j
            j, k = i, last

    def floor(self) -> np.ndarray:
        """By segment length and kind: a score up to which staying outside is as good, whatever
        comes before and after. Segments that do not exceed it are in no best cut."""
        out, turns = len(KINDS), self.turns()
        before = (turns[:, out : out + 1] - turns[:, :out]).min(axis=0)
        # At the end of an island nothing comes after.
        after = np.minimum((turns[out] - turns[:out]).min(axis=1), 0.0)
        between = np.arange(MAX_TOKENS)[:, None] * turns[out, out]
        return MARGIN + between + before + after


#: What the arrays of a block keep of a token: its form up to the length that features look at.
FORM, LOOSE = 24, 16
_ONES = np.uint32(0xFFFFFFFF)
#: What the checksum makes of each byte.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = (_CRC >> np.uint32(1)) ^ (_CRC & np.uint32(1)) * np.uint32(0xEDB88320)


@lru_cache(1 << 15)
def _token(token: str) -> tuple:
    """(form, first and last mark of the form, digits, weight, marks, letters, may begin a span, may
    end one, whether it is a line's end, a number up to 255)."""
    form = str(min(len(token), 5)) if token.isascii() and token.isdecimal() else shape(token)
    weight = 4 if token == "@" else 0
    if HIT.search(token):
        weight += sum(c.isdecimal() for c in token)
    return (
        form[:FORM],
        form[0],
        form[-1],
        NOT_DIGIT.sub("", token),
        weight,
        "".join(sorted(set(form) - set("a12345_"))),
        "a" in form,
        token[0].isalnum() or token[0] in "+(",
        token[-1].isalnum(),
        token[0] in "\n\r",
        token.isdecimal() and len(token) < 4 and int(token) < 256,
    )


@lru_cache(1 << 12)
def _beside(side: str, char: str) -> int:
    return slot(side, shape(char))


def _open_crc(*parts: object) -> np.uint32:
    """The running checksum of a feature's name, to which its last part is added byte by byte."""
    return np.uint32(crc32("".join(f"{p}|" for p in parts).encode())) ^ _ONES


def _closed(running: np.ndarray) -> np.ndarray:
    return ((running ^ _ONES) & np.uint32((1 << BITS) - 1)).astype(np.int64)


class _Forms:
    """The UTF-8 bytes of short texts, character by character."""

    def __init__(self, texts: list[str]):
        self.size = np.array([len(t) for t in texts])
        longest = int(self.size.max(initial=0))
        codes = np.zeros((len(texts), longest), np.uint32)
        for n, t in enumerate(texts):
            codes[n, : len(t)] = [ord(c) for c in t]
        self.codes = codes
        self.ascii = bool((codes < 128).all())

    def added(self, running: np.ndarray, of: np.ndarray, k: int) -> np.ndarray:
        """`running` with the k-th character of the texts `of`, all of them so long."""
        code = self.codes[of, k]
        if self.ascii:
            return _stepped(running, code)
        out = running.copy()
        for low, high, lead, shift in (
            (0, 1 << 7, 0, 0), (1 << 7, 1 << 11, 0xC0, 6), (1 << 11, 1 << 16, 0xE0, 12),
            (1 << 16, 1 << 21, 0xF0, 18),
        ):
            at = np.flatnonzero((code >= low) & (code < high))
            c = code[at]
            state = _stepped(out[at], lead | (c >> np.uint32(shift)))
            for s in range(shift - 6, -1, -6):
                state = _stepped(state, 0x80 | ((c >> np.uint32(s)) & 0x3F))
            out[at] = state
        return out


def _stepped(running: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _CRC[(running ^ byte) & np.uint32(255)] ^ (running >> np.uint32(8))


class _Marks:
    """Sets of marks, numbered as they come up."""

    def __init__(self, texts: list[str]):
        self.texts, self.sets = texts, [""]
        self.numbers, self.slots = {"": 0}, [slot("marks", "")]

    def joined(self, sets: np.ndarray, of: np.ndarray) -> np.ndarray:
        pairs, place = np.unique(sets * len(self.texts) + of, return_inverse=True)
        after = []
        for pair in pairs.tolist():
            number, token = divmod(pair, len(self.texts))
            name = "".join(sorted({*self.sets[number], *self.texts[token]}))
            if name not in self.numbers:
                self.numbers[name] = len(self.sets)
                self.sets.append(name)
                self.slots.append(slot("marks", name))
            after.append(self.numbers[name])
        return np.array(after, np.int64)[place]


#: A range of a text to look at, with a number by which the caller knows the text.
Piece = tuple[int, str, int, int]
Columns = tuple[np.ndarray, ...]


def candidates(pieces: Iterable[Piece], block: int = 8192) -> Iterator[tuple[Columns, np.ndarray]]:
    """The spans of the lattices of all pieces, a block of tokens at a time: (place of the piece, first
    token, end token, start, end) as columns and, by row, the slots of `features`, in some order.

    Tokens are numbered through all pieces, with one number left out between two pieces. Spans of
    equal length grow side by side, so that a token costs array operations only.
    """
    for tokens, piece, number, starts, ends, left, right, fresh in token_blocks(pieces, block):
        known: dict[str, int] = {}
        of = np.array([known.setdefault(t, len(known)) for t in tokens])
        facts = [_token(t) if len(t) <= 64 else _token.__wrapped__(t) for t in known]
        form, first, last, digits, weight, marks, letters, begins, closes, breaks, octet = zip(
            *facts, strict=True
        )
        forms, lasts, sets = _Forms(list(form)), _Forms(list(last)), _Marks(list(marks))
        marked = np.array([bool(m) for m in marks])
        is_digit = (forms.codes >= 49) & (forms.codes <= 53)
        is_joint = np.isin(forms.codes, [ord(c) for c in " ._-"])
        opened = np.array([_open_crc("ends", f) for f in first], np.uint32)
        closes, octet = np.array(closes)[of], np.array(octet)[of]
        n_digits = np.array([len(d) for d in digits])[of]

        def upto(x: Iterable) -> np.ndarray:
            return np.r_[0, np.cumsum(np.array(x, np.int64)[of])]

        weights, lettered, digit_at = upto(weight), upto(letters), np.r_[0, np.cumsum(n_digits)]
        is_at = np.array([t == "@" for t in known])
        ats = upto(is_at)
        is_dot = np.array([t == "." for t in known])[of]
        n = len(tokens)
        places = np.arange(n)
        last_dot = np.maximum.accumulate(np.where(is_dot, places, -1))
        next_at = np.minimum.accumulate(np.where(is_at[of], places, n)[::-1])[::-1]
        # A span ends before a line's end and with its piece.
        stop = np.where(np.array(breaks)[of], places, n)
        cut = np.flatnonzero(np.diff(number) > 1)
        stop[cut] = np.minimum(stop[cut], cut + 1)
        stop = np.minimum.accumulate(stop[::-1])[::-1]
        ip = np.zeros(n, bool)
        if n >= 7:
            ip[: n - 6] = True
            for k in range(7):
                ip[: n - 6] &= (is_dot if k % 2 else octet)[k : n - 6 + k]
        d = np.frombuffer("".join(digits[o] for o in of.tolist()).encode(), np.uint8).astype(np.int64) - 48
        odd = np.arange(len(d)) & 1
        twice = 2 * d - 9 * (d > 4)
        # Sums of a number's checksum, by whether its last digit has an even place.
        check = [np.r_[0, np.cumsum(np.where(odd == x, d, twice))] for x in (0, 1)]
        digit_slots = np.array([[slot("digits", m, x) for x in (False, True)] for m in range(21)])
        luhn_slots = np.array([slot("luhn", x) for x in (False, True)])
        octet_slots = np.array([slot("octets", x) for x in (False, True)])
        at_slots = np.array([[slot("at", m, x) for x in (False, True)] for m in range(MAX_TOKENS + 1)])

        at = np.flatnonzero(np.array(begins)[of][:fresh] & (stop[:fresh] > places[:fresh]))
        full = np.full(len(at), _open_crc("form"), np.uint32)
        loose = np.full(len(at), _open_crc("loose"), np.uint32)
        n_full, n_loose, state, held = (np.zeros(len(at), np.int64) for _ in range(4))
        spans: list[Columns] = []
        slots: list[np.ndarray] = []
        for size in range(MAX_TOKENS):
            if size:
                on = np.flatnonzero(stop[at] > at + size)
                at, full, loose, n_full, n_loose, state, held = (
                    x[on] for x in (at, full, loose, n_full, n_loose, state, held)
                )
            if not len(at):
                break
            j = at + size
            token = of[j]
            length = forms.size[token]
            for k in range(int(length.max())):
                row = np.flatnonzero(length > k)
                t = token[row]
                short = row[n_full[row] < FORM]
                full[short] = forms.added(full[short], token[short], k)
                n_full[short] += 1
                was, digit = state[row], is_digit[t, k]
                joint = ~digit & is_joint[t, k] & (was == 2)
                # Runs of digits with single marks between them are one 9.
                new = row[digit & (was == 0) & (n_loose[row] < LOOSE)]
                loose[new] = _stepped(loose[new], np.uint32(ord("9")))
                n_loose[new] += 1
                new = row[~digit & ~joint & (n_loose[row] < LOOSE)]
                loose[new] = forms.added(loose[new], token[new], k)
                n_loose[new] += 1
                state[row] = np.where(digit, 2, np.where(joint, 1, 0))
            row = np.flatnonzero(marked[token])
            held[row] = sets.joined(held[row], token[row])

            row = np.flatnonzero((weights[j + 1] - weights[at] >= 4) & closes[j])
            if not len(row):
                continue
            i, j, token = at[row], j[row], token[row]
            low, high = digit_at[i], digit_at[j + 1]
            many = high - low
            words = lettered[j + 1] > lettered[i]
            even = (high - 1) & 1
            total = np.where(even, check[1][high] - check[1][low], check[0][high] - check[0][low])
            good = (many > 13) & (many < 20) & ~words & (total % 10 == 0)
            ends_slot = opened[of[i]]
            for k in range(int(lasts.size.max())):
                ends_slot = lasts.added(ends_slot, token, k)
            found = np.empty((len(row), 11), np.int64)
            found[:, 0] = slot("bias")
            found[:, 1] = _closed(full[row])
            found[:, 2] = _closed(loose[row])
            found[:, 3] = digit_slots[np.minimum(many, 20), words.astype(int)]
            found[:, 4] = luhn_slots[good.astype(int)]
            found[:, 5] = octet_slots[(ip[i] if size == 6 else np.zeros(len(i), bool)).astype(int)]
            found[:, 6] = at_slots[ats[j + 1] - ats[i], (last_dot[j] > next_at[i]).astype(int)]
            found[:, 7] = np.array(sets.slots)[held[row]]
            found[:, 8] = left[i]
            found[:, 9] = right[j]
            found[:, 10] = _closed(ends_slot)
            spans.append((piece[i], number[i], number[j] + 1, starts[i], ends[j]))
            slots.append(found)
        if spans:
            yield tuple(map(np.concatenate, zip(*spans, strict=True))), np.concatenate(slots)


def token_blocks(pieces: Iterable[Piece], block: int) -> Iterator[tuple]:
    """Tokens in blocks, each with those that spans of it may reach into: (texts, places of pieces,
    numbers, starts, ends, slots of the marks before and after, how many are the block's own)."""
    tokens: list[str] = []
    rows: list[tuple[int, ...]] = []
    number = 0
    for place, (_, text, start, end) in enumerate(pieces):
        for m in TOKEN.finditer(text, start, end):
            a, b = m.span()
            left, right = _beside("left", text[max(0, a - 1) : a]), _beside("right", text[b : b + 1])
            tokens.append(m.group())
            rows.append((place, number, a, b, left, right))
            number += 1
            if len(tokens) == block + MAX_TOKENS:
                yield tokens, *np.array(rows, np.int64).T, block
                tokens, rows = tokens[block:], rows[block:]
        number += 1
    if tokens:
        yield tokens, *np.array(rows, np.int64).T, len(tokens)


def decoded(field: Field, pieces: Iterable[Piece]) -> Iterator[tuple[int, Span]]:
    """What `Field.best` finds in the lattices of pieces of any length, each with its piece's number.

    Most candidates score so low that staying outside is as good, whatever surrounds them. Where
    the others lie apart, each group of them is cut on its own.
    """
    floor = field.floor()
    weights = np.ascontiguousarray(field.w[: field.size].reshape(len(KINDS), -1).T)
    met: list[tuple[int, int]] = []

    def noted() -> Iterator[Piece]:
        for piece in pieces:
            met.append((piece[0], piece[3]))
            yield piece

    far: list[tuple] = []
    for spans, slots in candidates(noted()):
        scores = np.zeros((len(slots), len(KINDS)))
        for column in slots.T:
            scores += weights[column]
        at = np.flatnonzero((scores > floor[spans[2] - spans[1] - 1]).any(axis=1))
        far += zip(*(c[at].tolist() for c in spans), scores[at], strict=True)
    far.sort(key=lambda c: c[1:3])
    group: list[tuple] = []
    reach = 0
    for c in [*far, None]:
        # One token outside parts two groups: what comes before it and after do not meet.
        if group and (c is None or c[1] > reach):
            name, end = met[group[0][0]]
            for span in _cut_group(field, group, reach, end):
                yield name, span
            group = []
        if c is not None:
            reach = max(reach, c[2]) if group else c[2]
            group.append(c)


def _cut_group(field: Field, group: list, reach: int, end: int) -> Iterator[Span]:
    first = group[0][1]
    # The token after the group, if there is one, is outside.
    more = max(c[4] for c in group) < end
    into: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(reach - first + 1 + more)]
    places = {}
    for _, i, j, a, b, scores in group:
        into[j - first].append((i - first, scores))
        places[i - first], places[-(j - first)] = a, b
    for k, i, j in field.cut(into):
        yield KINDS[k], places[i], places[-j]


def variants(text: str, spans: list[Span]) -> Iterator[tuple[str, list[Span]]]:
    """The island itself, and its phone numbers and cards in other notations, or broken."""
    yield text, spans
    for kind, a, b in spans:
        old = text[a:b]
        digits = NOT_DIGIT.sub("", old)
        if kind == "phone":
            area, mid, line = digits[-10:-7], digits[-7:-4], digits[-4:]
            new = [(f"({area}) {mid}-{line}", 1), (f"{area}-{mid}-{line}", 1), (digits[-8:], 0)]
            new.append((f"20{line[:2]}-0{mid[0]}-1{mid[1]}", 0))
        elif kind == "card":
            wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
            groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
            new = [(".".join(groups), 1), (wrong, 0), (digits[:12], 0), (digits[:9], 0)]
        elif kind == "ip":
            new = [(old.replace(".", ".9", 1).replace(".", ".77", 1), 0), (old.rpartition(".")[0], 0)]
        else:
            new = [(old.replace("@", " @ "), 0), (old.replace("@", "-"), 0)]
        for text_of, kept in new:
            moved = text[:a] + text_of + text[b:]
            yield moved, [(kind, a, a + len(text_of))] if kept else []


def train(texts: Iterable[str]) -> np.ndarray:
    """Weights fitted by Adagrad over the islands of the texts, in their order."""
    data = []
    for text in texts:
        spans = base_spans(text)
        for a, b in islands(text):
            a, b = max(0, a - 12), min(len(text), b + 12)
            inside = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
            if len(inside) > 1 or b - a > 400:
                continue
            for variant, gold in variants(text[a:b], inside):
                lattice = Lattice(variant, 0, len(variant))
                begins, ends = lattice.starts, lattice.ends
                marked = {}
                for kind, s, e in gold:
                    i, j = bisect_left(begins, s), bisect_left(ends, e)
                    if i < len(begins) and j < len(ends) and begins[i] == s and ends[j] == e:
                        marked[i, j + 1] = KINDS.index(kind)
                known = {(i, j) for j, found in enumerate(lattice.into) for i, _ in found}
                if known and marked.keys() <= known and len(marked) == len(gold):
                    data.append((lattice, marked))
    field = Field()
    seen = np.full(len(field.w), 1e-8)
    for _ in range(EPOCHS):
        for lattice, gold in data:
            at, grad = field.gradient(lattice, gold)
            at, place = np.unique(at, return_inverse=True)
            total = np.bincount(place, grad)
            seen[at] += total**2
            field.w[at] += RATE * total / np.sqrt(seen[at])
    return field.w


class _Cover:
    """Base spans of a text, by start, and which of them a range touches."""

    def __init__(self, base: list[Span]):
        self.spans = [(s, e) for _, s, e in base]
        self.starts = [s for s, _ in self.spans]
        self.reach = list(accumulate((e for _, e in self.spans), max))

    def touching(self, a: int, b: int) -> Iterator[tuple[int, int]]:
        at = bisect_left(self.starts, b) - 1
        while at >= 0 and self.reach[at] > a:
            if self.spans[at][1] > a:
                yield self.spans[at]
            at -= 1


def added_spans(field: Field, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """What the field finds in each text apart from every base span."""
    found: list[list[Span]] = [[] for _ in texts]
    covers = [_Cover(base) for base in bases]

    def pieces() -> Iterator[Piece]:
        for n, text in enumerate(texts):
            for a, b in islands(text):
                known = list(covers[n].touching(a, b))
                if not known or not all(s <= a and b <= e for s, e in known):
                    yield n, text, max(0, a - 1), min(len(text), b + 1)

    for n, span in decoded(field, pieces()):
        if not any(covers[n].touching(*span[1:])):
            found[n].append(span)
    return found


def learn(docs: DataFrame, text: str, rows: int) -> dict[int, float]:
    """Weights other than zero, learned in one task from at most `rows` documents."""
    bodies = docs.select(F.col(text).cast("string").alias("body"))
    sample = sampled(bodies.filter(F.col("body").rlike("[0-9@]")), F.xxhash64("body"), rows)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = train([t for b in batches for t in b.column(0).to_pylist()])
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["f", "w"])

    # At most one row per coordinate of the hashed vector.
    return {r.f: r.w for r in sample.mapInArrow(fit, "f bigint, w double").collect()}


SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)


def find_personal_data(
    docs: DataFrame, text: str = "text", into: str = "pii_spans", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """`docs` with one more column: spans (kind, start, end, base) in code points, end exclusive.

    Base spans are the patterns' matches, in every row; the others were added by the field and
    touch no base span. Rows, also repeated ones, keep all their columns; null and empty texts
    have no spans. An existing column called `into` is replaced. With nothing to learn from the
    field adds nothing.
    """
    weights = learn(docs, text, sample_rows)

    @F.pandas_udf(SPAN_TYPE)
    def spans_of(texts: pd.Series) -> pd.Series:
        w = np.zeros(Field().w.size)
        w[list(weights)] = list(weights.values())
        field = Field(w)
        bodies = [t or "" for t in texts]
        bases = [base_spans(t) for t in bodies]
        added = added_spans(field, bodies, bases) if weights else [[] for _ in bodies]
        out = []
        for base, more in zip(bases, added, strict=True):
            known = set(base)
            out.append(
                [
                    {"kind": k, "start": a, "end": b, "base": (k, a, b) in known}
                    for k, a, b in ordered(base + more)
                ]
            )
        return pd.Series(out, dtype=object)

    return docs.withColumn(into, spans_of(F.col(text).cast("string")))


def personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per document: (key, n_email, n_ip, n_card, n_phone, base_sha256, spans).

    The counts and the digest are of the base spans, `spans` lists all. A null text is empty;
    null keys and repeated rows stay as they are.
    """
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    found = find_personal_data(narrow, "body", "found", sample_rows).select("key", "found")
    base = F.filter("found", lambda s: s["base"])

    def line(spans: Column) -> Column:
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(each, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("key").alias(key),
        *map(count, KINDS),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`docs` with every span of personal data replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first. Null stays null.
    """
    rows = docs.select(boxed(docs), F.col(text).cast("string").alias("body"))
    found = find_personal_data(rows, "body", "found", sample_rows)

    @F.pandas_udf(T.StringType())
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, found in zip(texts, spans, strict=True):
            if t is None or not len(found):
                out.append(t)
                continue
            parts, end = [], 0
            for s in found:
                if s["start"] >= end:
                    parts += [t[end : s["start"]], f"<{s['kind'].upper()}>"]
                end = max(end, s["end"])
            out.append("".join([*parts, t[end:]]))
        return pd.Series(out, dtype=object)

    return found.select(F.col("row").withField(text, masked("body", "found")).alias("row")).select(
        "row.*"
    )
