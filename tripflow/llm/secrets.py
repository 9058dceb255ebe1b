"""Secret scan: fixed patterns, and a linear-chain conditional random field that adds what they miss.

Tokens are the words between white space, cut into pieces of one kind of character. Each piece is
tagged as outside (O), beginning (B) or inside (I) a secret from the shape and wording of its word
and of both neighbouring words, from itself and the pieces beside it in the word, and from features
of the whole file; the tags of a text are decoded together by Viterbi, so a span may run over several
words. No labelled secrets exist, so the field learns from where the patterns match, on a bounded
sample drawn by smallest hash from all documents, cut into windows, in SHARDS parts whose parameters
are averaged (the likelihood is convex). A match that stops inside a value is learned from up to the
value's end. So that the field learns secrets of other kinds than those matched, every text with a
match is also learned REWRITTEN times with its values, and what announces them, put in other
characters, drawn by the text's hash. Pattern spans always stay.

Defined results: a null or empty text has no spans; spans count code points and their ends are
exclusive; without any pattern match only the patterns are used; repeated rows get
equal rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Callable
from itertools import chain, groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.llm.common import Cache, by_batch, text_rows
from tripflow.session import stage

# The patterns of known kinds, in their order; the length that a match must reach.
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
KINDS = ("assign", "access", "hex", "crf")
NAMES = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
HEX_LENGTH = 24

#: The fit's bound: documents learned from with a match, and as many without one.
FIT_ROWS = 2_000
SHARDS = 4
EPOCHS = 8
HASHED = 1 << 12
RATE, DECAY = 0.3, 1e-4
O, B, I = range(3)
AROUND = 12
FORBIDDEN = -1e4

_WEAK = re.compile(rb"pass|pwd|secret|token|key|auth|cred|bearer|akia")
#: Pieces: letters, digits, bytes of other characters, signs that values hold, quotes and brackets one by one, any other signs.
_PIECE = re.compile(
    rb"""[A-Za-z]+|[0-9]+|[\x80-\xff]+|[+/_.=-]+|["'`,;:()\[\]{}<>|\\]|[^A-Za-z0-9\x80-\xff+/_.=\s"'`,;:()\[\]{}<>|\\-]+"""
)
#: What may follow a match inside the same value.
_REST = re.compile(rb"""[^\s"'`,;&<>()\[\]{}|\\]*""")
#: Further groups or lines of a quoted value: with a digit, or long.
_GROUPS = re.compile(rb"(?:\s+(?=[A-Za-z+/_.=-]*[0-9]|[A-Za-z+/_.=-]{16})[A-Za-z0-9+/_.=-]+)*")
_EDGE = b"\"'`,;:()[]{}<>!?#$%&*|\\"
_QUOTES = b"\"'`,;:()[]{}<>|\\"
#: Letters, digits and other characters by kind; white space and the signs of an assignment stay.
_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 48 if 48 <= c <= 57 else 120 if c >= 128 else c if chr(c) in " \t\n\v\f\r=:\"'" else 46
    for c in range(256)
)
#: Tokens up to this length give their own word, longer ones their start.
LONG = 16
#: Rows of tokens that a worker keeps; tokens longer than KEPT bytes are worked out each time.
HELD_ROWS, KEPT = 300_000, 64
#: Places of one text to learn from: of matches, of other tokens with digits, spread over the text, and the longest other tokens.
MATCHES, NUMBERS, LONGEST = 8, 4, 4
#: A window's pieces to each side of the place it is cut around.
PIECES = 160
#: How often a text with matches is learned from with other values.
REWRITTEN = 3
_LOWER, _UPPER, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_ALPHABETS = (_LOWER + _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS + b"+/", _LOWER + _DIGITS, _UPPER + _DIGITS, _DIGITS + b"abcdef", _DIGITS + b"ABCDEF")
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32]] = True


#: Digits of HEX as ``h``, all else blank: a run of them is found as a fixed text, long before an expression tries each place.
_HEX_RUNS = bytes(104 if chr(c) in "0123456789abcdef" else 32 for c in range(256))


def pattern_spans(text: bytes) -> list[tuple[str, int, int, int]]:
    """(kind, begin, end, begin of the secret itself) in bytes, per kind leftmost and without overlap."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [("assign", m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LENGTH]
    if b"AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    if b"h" * HEX_LENGTH in text.translate(_HEX_RUNS):
        found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return found


def has_match(text: bytes) -> bool:
    return bool(pattern_spans(text))


def shape_features(shape: bytes) -> list[bytes]:
    core = shape.strip(b".=:\"'")
    n = max(min(len(core), 64), 1)
    digits, upper, lower = core.count(b"0"), core.count(b"A"), core.count(b"a")
    return [
        b"always",
        b"length%d" % (n // 4),
        b"shape" + bytes(c for c, _ in groupby(core[:64]))[:8],
        b"kinds%d%d%d" % (digits > 0, upper > 0, lower > 0),
        b"digits%d" % (5 * min(digits, n) // n),
        b"changes%d" % (min(16, sum(a != b for a, b in zip(core[:64], core[1:65]))) // 2),
        b"assigns%d" % (b"=" in shape or b":" in shape),
    ]


def _hashed(part: bytes) -> int:
    return zlib.crc32(part) % HASHED


_OF_SHAPE = Cache(lambda shape: [_hashed(p) for p in shape_features(shape)], 100_000)
_DISTINCT = [_hashed(b"distinct%d" % i) for i in range(64 // 4 + 1)]
_NAMES = _hashed(b"names a secret")


def token_features(token: bytes, weak: bool) -> list[int]:
    """Hashed features of one token: its shape, its characters and its wording."""
    shape = token.translate(_SHAPE)
    core = token.strip(_EDGE)
    own = _OF_SHAPE[shape] if len(shape) <= KEPT else [_hashed(p) for p in shape_features(shape)]
    own = [*own, _DISTINCT[len(set(core[:64])) // 4], _hashed(b"last" + token[-1:])]
    if weak:
        own.append(_NAMES)
    if weak or len(core) <= LONG:
        own.append(_hashed(b"word" + core[:LONG].lower()))
    if len(core) >= LONG:
        own += [_hashed(b"start" + core[:4]), _hashed(b"hex%d" % (not core[:64].strip(b"0123456789abcdefABCDEF")))]
        head = core[:64].translate(_SHAPE)
        own.append(_hashed(b"long%d%d" % (b"0" in head, (b"A" in head) + (b"a" in head))))
    return own


def piece_features(piece: bytes) -> list[int]:
    """Hashed features of one piece: its kind of characters, length and wording."""
    shape = piece[:64].translate(_SHAPE)
    kinds = b"".join(k for k in (b"A", b"a", b"0", b"x") if k in shape) or b"sign" + piece[:4]
    parts = [b"piece", b"piece of " + kinds, b"piece length%d" % min(len(piece), 24)]
    if len(piece) <= LONG and piece.isalpha():
        parts.append(b"piece " + piece.lower())
    if _WEAK.search(piece.lower()):
        parts.append(b"piece names a secret")
    return [_hashed(p) for p in parts]


def pieces_of(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The pieces of all ``tokens`` in order, and how many each has."""
    cut = list(map(_PIECE.findall, tokens))
    return list(chain.from_iterable(cut)), np.fromiter(map(len, cut), np.int64, len(cut))


def weak_tokens(text: bytes, lowered: bytes) -> set[int]:
    """The numbers of the tokens whose letters name a secret."""
    found = [m.start() for m in _WEAK.finditer(lowered)]
    return set((np.searchsorted(places(text)[0], found, "right") - 1).tolist()) if found else set()


def file_features(text: bytes, n: int) -> np.ndarray:
    """Features of the whole file: its length and how much it assigns."""
    n = max(n, 1)
    return np.array([np.log1p(n) / 10, min(1.0, 20 * text.count(b"=") / n), min(1.0, 20 * text.count(b":") / n)])


class Rows:
    """Sums of the weights of the features of words: of each its own tag, the one after and the one before, and ``lead``."""

    def __init__(self, by_feature: np.ndarray, features: Callable[[bytes], list[int]], lead: Callable | None = None):
        self.by_feature, self.features, self.lead = by_feature, features, lead
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.table, self.used = np.zeros((1024, 10)), 0

    def _number(self, new: list[bytes]) -> None:
        features = list(map(self.features, new))
        before, self.used = self.used, self.used + len(new)
        while self.used > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        starts = np.cumsum([0, *map(len, features[:-1])])
        self.table[before : self.used, :9] = np.add.reduceat(self.by_feature[list(chain.from_iterable(features))], starts)
        if self.lead:
            self.table[before : self.used, 9] = self.lead(new)
        self.rows.update(zip(new, range(before, self.used)))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The rows of ``table`` that hold ``words``; those of earlier calls may be gone."""
        if self.used > HELD_ROWS:
            self._forget()
        rows = self.rows
        new = list(set(words).difference(rows))
        if new:
            self._number(new)
        at = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
        for word in new:
            if len(word) > KEPT:
                del rows[word]
        return at


class Field:
    """Weights by role (own, before, after), feature and tag; of the file by tag; of tag after tag."""

    SHAPES = ((3, HASHED, 3), (3, 3), (3, 3))
    SIZE = 9 * HASHED + 18

    def __init__(self, flat: np.ndarray):
        self.flat = flat
        self.word = flat[: 9 * HASHED].reshape(self.SHAPES[0])
        self.file = flat[9 * HASHED : 9 * HASHED + 9].reshape(3, 3)
        self.step = flat[9 * HASHED + 9 :].reshape(3, 3)
        by_feature = self.word.transpose(1, 0, 2).reshape(HASHED, 9)
        self.pieces = Rows(by_feature, piece_features)
        self.tokens = Rows(by_feature, lambda t: token_features(t, bool(_WEAK.search(t.lower()))), self._lead)

    @property
    def used(self) -> int:
        return self.tokens.used

    def within(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What the pieces of ``tokens`` add to the tags of each piece, and how many pieces each token has."""
        pieces, counts = pieces_of(tokens)
        at = self.pieces.numbers(pieces)  # may replace the table
        each = self.pieces.table[at]
        out = each[:, 0:3].copy()
        inner = np.ones(len(pieces), bool)
        inner[np.cumsum(counts)[:-1]] = False  # a token's first piece has none before it
        inner = inner[1:, None]
        out[1:] += each[:-1, 3:6] * inner
        out[:-1] += each[1:, 6:9] * inner
        return out, counts

    def _lead(self, tokens: list[bytes]) -> np.ndarray:
        """By how much the pieces of each token raise another tag over O at most."""
        own, counts = self.within(tokens)
        return np.maximum.reduceat(own[:, 1:].max(1) - own[:, O], np.cumsum([0, *counts[:-1]]))

    def emissions(self, text: bytes, tokens: list[bytes]) -> np.ndarray:
        return self._of_rows(text, self._rows_of(tokens))

    def _rows_of(self, tokens: list[bytes]) -> np.ndarray:
        at = self.tokens.numbers(tokens)  # may replace the table
        return self.tokens.table[at]

    def _of_rows(self, text: bytes, each: np.ndarray) -> np.ndarray:
        out = each[:, 0:3] + file_features(text, len(each)) @ self.file
        out[1:] += each[:-1, 3:6]
        out[:-1] += each[1:, 6:9]
        return out

    def piece_tags(self, text: bytes, tokens: list[bytes]) -> list[int]:
        """The best tags of all pieces; none if every piece is outside."""
        rows = self._rows_of(tokens)
        words = self._of_rows(text, rows)
        if self._outside((words[:, O] - words[:, 1:].max(1) - rows[:, 9]).min()):
            return []
        own, counts = self.within(tokens)
        return self.tags(np.repeat(words, counts, 0) + own)

    def _outside(self, margin: float) -> bool:
        """Whether O everywhere is best: leaving it costs more than its transitions can bring."""
        return margin > 2 * max(0.0, float(self.step.max() - self.step[O, O]))

    def tags(self, emissions: np.ndarray) -> list[int]:
        """The best tags by Viterbi; inside never follows outside."""
        if self._outside((emissions[:, O] - emissions[:, 1:].max(1)).min()):
            return []
        step = self.step.copy()
        step[O, I] = FORBIDDEN
        (oo, ob, oi), (bo, bb, bi), (io, ib, ii) = step.tolist()
        values = emissions.tolist()
        o, b, i = values[0][0], values[0][1], FORBIDDEN
        back = []
        for eo, eb, ei in values[1:]:
            to_o = (o + oo, O), (b + bo, B), (i + io, I)
            to_b = (o + ob, O), (b + bb, B), (i + ib, I)
            to_i = (o + oi, O), (b + bi, B), (i + ii, I)
            (no, po), (nb, pb), (ni, pi) = max(to_o), max(to_b), max(to_i)
            back.append((po, pb, pi))
            o, b, i = no + eo, nb + eb, ni + ei
        tag = max((o, O), (b, B), (i, I))[1]
        path = [tag]
        for before in reversed(back):
            tag = before[tag]
            path.append(tag)
        return path[::-1]


def places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words between white space, in bytes."""
    blank = np.concatenate([[True], _SPACE[np.frombuffer(text, np.uint8)], [True]])
    turn = np.diff(blank.view(np.int8))
    return np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)


def piece_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the pieces, in bytes."""
    spans = np.array([m.span() for m in _PIECE.finditer(text)], np.int64).reshape(-1, 2)
    return spans[:, 0], spans[:, 1]


def value_end(text: bytes, end: int, secret: int) -> int:
    """Where the value ends that a match from ``secret`` to ``end`` begins: at its quote, or before the punctuation after it."""
    rest = _REST.match(text, end).end()
    quote = text[secret - 1 : secret] if secret else b""
    if quote and quote in b"\"'`":
        for closed in (rest, _GROUPS.match(text, rest).end()):
            if text[closed : closed + 1] == quote:
                return closed
    return end + len(text[end:rest].rstrip(_EDGE + b"."))


def field_spans(text: bytes, field: Field) -> list[tuple[str, int, int, int]]:
    """Spans that the field tags, in bytes, without the punctuation around them."""
    tokens = text.split()
    if not tokens:
        return []
    tags = field.piece_tags(text, tokens)
    if not any(tags):
        return []
    begins, ends = piece_places(text)
    out: list[list[int]] = []
    for at, tag in enumerate(tags):
        if tag == B or tag == I and not out:
            out.append([at, at])
        elif tag == I:
            out[-1][1] = at
    spans = []
    for first, last in out:
        begin, end = int(begins[first]), int(ends[last])
        piece = text[begin:end]
        begin += len(piece) - len(piece.lstrip(_QUOTES))
        end -= len(piece) - len(piece.rstrip(_QUOTES))
        end = closing(text, begin, end)
        if begin < end:
            spans.append(("crf", begin, end, begin))
    return spans


def closing(text: bytes, begin: int, end: int) -> int:
    """Where a span ends whose value stands in quotes: at the quote that closes it, if the span goes beyond."""
    quote = text[begin - 1 : begin] if begin else b""
    closed = text.find(quote, begin, end) if quote and quote in b"\"'`" else -1
    return end if closed < 0 else closed


def contained(span: tuple, base: list[tuple]) -> bool:
    """Whether the spans of ``base`` together hold every byte of ``span``."""
    at = span[1]
    for _, begin, end, _ in sorted((b for b in base if b[2] > span[1] and b[1] < span[2]), key=lambda b: b[1]):
        if begin > at:
            return False
        at = max(at, end)
    return at >= span[2]


def find(text: bytes, field: Field | None) -> tuple[list, list]:
    """(pattern spans, all spans) as (kind, begin, end) in code points, by begin and then kind.

    A span of the field that pattern spans contain wholly adds nothing; one that reaches beyond them stays beside them.
    """
    base = pattern_spans(text)
    more = field_spans(text, field) if field else []
    more = [m for m in more if not contained(m, base)]
    order = {kind: i for i, kind in enumerate(KINDS)}
    spans = sorted(base + more, key=lambda s: (s[1], order[s[0]], s[2]))
    if text.isascii():
        placed = [s[:3] for s in spans]
    else:
        cuts = sorted({p for s in spans for p in s[1:3]})
        chars, done, so_far = {}, 0, 0
        for cut in cuts:
            so_far += len(text[done:cut].decode("utf-8", "replace"))
            chars[cut], done = so_far, cut
        placed = [(k, chars[a], chars[b]) for k, a, b, _ in spans]
    return [s for s in placed if s[0] != "crf"], placed


def spread(places: list[int], most: int) -> list[int]:
    """At most ``most`` of ``places``, evenly over all of them."""
    n = len(places)
    return places if n <= most else [places[i * (n - 1) // (most - 1)] for i in range(most)]


def values(text: bytes) -> list[tuple[int, int, int]]:
    """(begin of the match, begin and end of its value), without those inside an earlier one's value."""
    out: list[tuple[int, int, int]] = []
    for _, begin, end, secret in sorted(pattern_spans(text), key=lambda m: (m[3], m[1])):
        if not out or secret >= out[-1][2]:
            out.append((begin, secret, value_end(text, end, secret)))
    return out


def other_value(draw: random.Random) -> bytes:
    """A value in one of the alphabets, whole or in groups, some behind a short name."""
    alphabet = draw.choice(_ALPHABETS)
    sign = bytes([draw.choice(b"-_")])
    groups = [draw.randrange(16, 49)] if draw.random() < 0.7 else [draw.randrange(4, 13) for _ in range(draw.randrange(3, 6))]
    made = [bytes(draw.choices(alphabet, k=n - 1)) + bytes([draw.choice(_DIGITS)]) for n in groups]
    name = [bytes(draw.choices(_LOWER, k=draw.randrange(2, 7)))] if draw.random() < 0.4 else []
    return sign.join(name + made)


def rewritten(text: bytes, draw: random.Random) -> tuple[bytes, list[tuple[int, int]]]:
    """The text with every value replaced, announced as before, by another of its words, or not at all; and where the values stand."""
    own = text[:4096].split()
    out, done, marks = b"", 0, []
    for begin, secret, end in values(text):
        begin = max(begin, done)
        lead, way = text[begin:secret], draw.randrange(4)
        quote = lead[-1:] if lead[-1:] in (b'"', b"'") else b""
        if way == 1:
            lead = draw.choice(own).strip(_EDGE) + draw.choice((b" = ", b": ", b"=", b" ")) + quote
        elif way > 1:
            lead = b""
        out += text[done:begin] + lead
        value = other_value(draw)
        marks.append((len(out), len(out) + len(value)))
        done = end + 1 if quote and not lead and text[end : end + 1] == quote else end
        out += value
    return out + text[done:], marks


def learned_from(text: bytes) -> list[tuple]:
    """The windows of a text, and with matches those around the values of its rewritten forms."""
    out = windows(text)
    if values(text):
        draw = random.Random(zlib.crc32(text))
        for _ in range(REWRITTEN):
            out += [w for w in windows(*rewritten(text, draw)) if any(w[2])]
    return out


def windows(text: bytes, marks: list[tuple[int, int]] | None = None) -> list[tuple]:
    """Places to learn from, around matches, numbers, the longest words and the middle, over the whole text.

    ``marks`` are begins and ends of the values; without them, those of the patterns. Each is (token features, file features, tags of the pieces, features of the pieces, token of each piece).
    """
    tokens = text.split()
    if not tokens:
        return []
    begins, ends = piece_places(text)
    pieces, counts = pieces_of(tokens)
    firsts = np.cumsum([0, *counts])  # of each token
    of = np.repeat(np.arange(len(tokens)), counts)
    tags = np.zeros(len(pieces), np.int64)
    if marks is None:
        marks = [(secret, value_end(text, end, secret)) for _, _, end, secret in pattern_spans(text)]
    for secret, end in marks:
        first, last = np.searchsorted(ends, secret, "right"), np.searchsorted(begins, end, "left") - 1
        tags[first] = B if tags[first] == O else tags[first]
        tags[first + 1 : last + 1] = I
    digit = re.compile(rb"[0-9]")
    marked = np.flatnonzero(tags == B).tolist()
    inside = np.maximum.reduceat(tags, firsts[:-1]) > 0
    plain = [int(firsts[i]) for i, t in enumerate(tokens) if not inside[i] and len(t) > 5 and digit.search(t)]
    longest = [int(firsts[i]) for i in sorted(np.flatnonzero(~inside).tolist(), key=lambda i: (-len(tokens[i]), i))[:LONGEST]]
    whole = file_features(text, len(tokens))
    weak = weak_tokens(text, text.lower())
    ranges: list[list[int]] = []
    for at in sorted({*spread(marked, MATCHES), *spread(plain, NUMBERS), *longest, int(firsts[len(tokens) // 2])}):
        low, high = max(0, of[at] - AROUND), min(len(tokens), of[at] + AROUND + 1)
        first, end = max(int(firsts[low]), at - PIECES), min(int(firsts[high]), at + PIECES)
        if ranges and first <= ranges[-1][1]:
            ranges[-1][1] = max(end, ranges[-1][1])
        else:
            ranges.append([first, end])
    out = []
    for first, end in ranges:
        while first < end and tags[first] == I:
            first += 1  # a window never begins inside a secret
        if first < end:
            low, high = of[first], of[end - 1] + 1
            own = [token_features(tokens[i], i in weak) for i in range(low, high)]
            out.append((own, whole, tags[first:end].tolist(), [piece_features(p) for p in pieces[first:end]], of[first:end] - low))
    return out


class Window:
    """One window to learn from, its features numbered once for all passes."""

    def __init__(self, tokens: list, whole: np.ndarray, tags: list[int], pieces: list | None = None, of: np.ndarray | None = None):
        self.whole, self.tags, self.n = whole, np.asarray(tags), len(tags)
        self.of = np.arange(self.n) if of is None else np.asarray(of)
        self.firsts = np.searchsorted(self.of, np.arange(len(tokens)))  # of each token's pieces
        self.lengths = np.array([len(f) for f in chain(tokens, pieces or [])])
        self.starts = np.cumsum(self.lengths) - self.lengths
        features = np.fromiter(chain.from_iterable(chain(tokens, pieces or [])), np.int64)
        self.used, self.number = np.unique(features, return_inverse=True)
        self.order = np.argsort(self.number, kind="stable")
        self.bounds = np.searchsorted(self.number[self.order], np.arange(len(self.used)))
        self.split, self.words = bool(pieces), len(tokens)
        self.within = (self.of[1:] == self.of[:-1])[:, None]
        self.moves = np.zeros((3, 3))
        np.add.at(self.moves, (self.tags[:-1], self.tags[1:]), 1)

    def emissions(self, weights: np.ndarray, file: np.ndarray) -> np.ndarray:
        """What each piece's tags get, of the ``weights`` of the used features (own tag, the one after, the one before)."""
        each = np.add.reduceat(weights[self.number], self.starts)
        word = each[: self.words]
        em = word[:, 0:3] + self.whole @ file
        em[1:] += word[:-1, 3:6]
        em[:-1] += word[1:, 6:9]
        em = em[self.of]
        if self.split:
            piece = each[self.words :]
            em += piece[:, 0:3]
            em[1:] += piece[:-1, 3:6] * self.within
            em[:-1] += piece[1:, 6:9] * self.within
        return em

    def gradient(self, share: np.ndarray) -> np.ndarray:
        """The gradient of the used features' weights, from that of each piece's tags."""
        rows = np.zeros((len(self.lengths), 9))
        word = np.add.reduceat(share, self.firsts)
        rows[: self.words, 0:3] = word
        rows[: self.words - 1, 3:6] = word[1:]
        rows[1 : self.words, 6:9] = word[:-1]
        if self.split:
            piece = rows[self.words :]
            piece[:, 0:3] = share
            piece[:-1, 3:6] = share[1:] * self.within
            piece[1:, 6:9] = share[:-1] * self.within
        return np.add.reduceat(np.repeat(rows, self.lengths, 0)[self.order], self.bounds)


def marginals(emissions: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each piece's share of every tag, and the expected number of each tag after each, over all taggings."""
    n = len(emissions)
    e = np.exp(np.maximum(emissions - emissions.max(1, keepdims=True), -500))
    e[0, I] = 0
    move = np.exp(step - step.max())
    move[O, I] = 0
    (oo, ob, _), (bo, bb, bi), (io, ib, ii) = move.tolist()
    rows = e.tolist()
    o, b, i = rows[0]
    total = o + b
    forward = [(o / total, b / total, 0.0)]
    for eo, eb, ei in rows[1:]:
        o, b, i = forward[-1]
        no, nb, ni = (o * oo + b * bo + i * io) * eo, (o * ob + b * bb + i * ib) * eb, (b * bi + i * ii) * ei
        total = no + nb + ni
        forward.append((no / total, nb / total, ni / total))
    o = b = i = 1.0
    backward = [(o, b, i)]
    for eo, eb, ei in reversed(rows[1:]):
        o, b, i = o * eo, b * eb, i * ei
        no, nb, ni = o * oo + b * ob, o * bo + b * bb + i * bi, o * io + b * ib + i * ii
        total = no + nb + ni
        o, b, i = no / total, nb / total, ni / total
        backward.append((o, b, i))
    alpha, beta = np.array(forward), np.array(backward[::-1])
    share = alpha * beta
    share /= share.sum(1, keepdims=True)
    if n == 1:
        return share, np.zeros((3, 3))
    ahead = e[1:] * beta[1:]
    ahead /= np.einsum("ta,ab,tb->t", alpha[:-1], move, ahead)[:, None]
    return share, move * (alpha[:-1].T @ ahead)


def learn(start: np.ndarray, samples: list) -> np.ndarray:
    """The field after EPOCHS passes of per-coordinate gradient steps over windows."""
    field = Field(start.copy())
    weights = field.word.transpose(1, 0, 2).reshape(HASHED, 9).copy()
    grown, grown_file, grown_step = np.full((HASHED, 9), 1e-2), np.full((3, 3), 1e-2), np.full((3, 3), 1e-2)

    def stepped(values: np.ndarray, gradient: np.ndarray, grown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gradient = np.where(gradient != 0, gradient + DECAY * values, 0)
        grown = grown + gradient * gradient
        return values - RATE * gradient / np.sqrt(grown), grown

    prepared = [Window(*sample) for sample in samples]
    for _ in range(EPOCHS):
        for window in prepared:
            used = window.used
            share, moves = marginals(window.emissions(weights[used], field.file), field.step)
            share[np.arange(window.n), window.tags] -= 1
            weights[used], grown[used] = stepped(weights[used], window.gradient(share), grown[used])
            field.file[:], grown_file = stepped(field.file, window.whole[:, None] * share.sum(0), grown_file)
            field.step[:], grown_step = stepped(field.step, moves - window.moves, grown_step)
    field.word[:] = weights.reshape(HASHED, 3, 3).transpose(1, 0, 2)
    return field.flat


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> Field | None:
    """The field learned from at most ``rows`` documents with and as many without a pattern match."""
    texts = text_rows(docs).select("text", F.xxhash64("text").alias("draw"))

    def marked(batch: dict) -> dict:
        hit = [has_match(t) for t in batch["text"]]
        return {"draw": batch["draw"], "hit": hit}

    # Every text is looked at; those with the smallest hashes of each kind are the same for every partitioning.
    drawn = stage(by_batch(texts, marked, "draw long, hit boolean").distinct(), "secret-draws")
    chosen = drawn.where("hit").orderBy("draw").limit(rows).union(drawn.where("NOT hit").orderBy("draw").limit(rows))
    # Dealt in turn: chosen has 2 * rows rows at most.
    dealt = chosen.withColumn("shard", F.row_number().over(W.orderBy("draw")) % SHARDS)
    return _fit_on(texts.join(F.broadcast(dealt), "draw").dropDuplicates(["draw"]))


def _fit_on(sample: DataFrame) -> Field | None:
    def run(parts):
        rows = pd.concat([*parts, pd.DataFrame({"draw": [], "text": [], "shard": []})])
        for _, part in rows.groupby("shard"):
            part = part.sort_values("draw")
            samples = [w for text in part["text"] for w in learned_from(text)]
            hits = sum(any(sample[2]) for sample in samples)
            flat = learn(np.zeros(Field.SIZE), samples) if hits else np.zeros(Field.SIZE)
            yield pd.DataFrame({"hits": [hits], "flat": [flat.astype(np.float32).tobytes()]})

    # By range of the few shard numbers, so that no two of them share a task.
    parts = sample.select("draw", "text", "shard").repartitionByRange(SHARDS, "shard").mapInPandas(run, "hits long, flat binary")
    found = [np.frombuffer(p["flat"], np.float32).astype(np.float64) for p in parts.collect() if p["hits"]]
    return Field(np.mean(found, axis=0)) if found else None


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """The contract's columns for every row: counts by kind, a digest of the pattern spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(field.flat if field else None)
    kept: dict[str, Field | None] = {}

    def run(batch: dict, flat: np.ndarray | None) -> dict:
        if "field" not in kept:
            kept["field"] = None if flat is None else Field(flat)
        found = [find(text, kept["field"]) for text in batch["text"]]

        def written(spans: list) -> str:
            return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)

        counts = {f"n_{kind}": [sum(s[0] == kind for s in base) for base, _ in found] for kind in KINDS[:3]}
        return counts | {
            "doc_id": batch["doc_id"],
            "base_sha256": [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found],
            "spans": [written(every) for _, every in found],
        }

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return by_batch(text_rows(docs), run, schema, shared)


def redact(docs: DataFrame, field: Field | None, mark: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, all columns, with every span of the text replaced by ``mark``; n_chars, where it stands, follows."""
    shared = docs.sparkSession.sparkContext.broadcast(field.flat if field else None)
    columns = docs.columns

    def masked(text: str | None, own: Field | None) -> str | None:
        if not text:
            return text
        out, done = [], 0
        for _, begin, end in find(text.encode(), own)[1]:
            if end > done:
                out += [text[done:begin], mark] if begin >= done else []
                done = end
        return "".join([*out, text[done:]])

    def run(batches):
        import pyarrow as pa

        own = None if shared.value is None else Field(shared.value)
        for batch in batches:
            texts = [masked(t, own) for t in batch.column("text").to_pylist()]
            at = columns.index("text")
            made = list(batch.columns)
            made[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in columns:
                n = columns.index("n_chars")
                made[n] = pa.array([c if t is None else len(t) for t, c in zip(texts, made[n].to_pylist())], batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(made, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def secrets(docs: DataFrame) -> DataFrame:
    return scan(docs, fit(docs))
