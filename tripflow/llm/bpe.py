"""Byte-level BPE: pre-tokenisation by class arrays and a scan of transition functions, cached merging, decoding.

Each code point is looked up in a class array. The split pattern is a small automaton over those
classes; every class is a function from state to state, the functions compose associatively, and
their closure under composition is small. A two-level scan over element numbers (steps inside
lanes, then over the lanes) therefore yields the state before every character of a whole batch of
texts without a regular expression, and with it the boundaries. The slices between boundaries are
merged by rank; a bounded cache keeps what a slice became.

Defined results: a null text is empty and has no ids; every other text, also one very long slice,
decodes to its own bytes; repeated rows give repeated rows; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
from functools import lru_cache
from itertools import pairwise

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import Cache, by_batch, text_rows

# The contractions, white space and pattern of the published byte-level split,
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
ONE_LETTER, BEFORE_E, BEFORE_L = "stmd", "rv", "l"

# Classes of code points, then of positions once the next character is known.
LETTER, SHORT, RV, EL, NUMBER, APOSTROPHE, OTHER, SPACE, WHITE = range(9)
INNER, LAST_SPACE, LAST_WHITE, RESET = 7, 8, 9, 10
CLASSES = 11

# States: what the character before was part of.
FRESH, LETTERS, NUMBERS, OTHERS, LED, GAP, QUOTE, PENDING = range(8)
STATES = 8

LANE = 256
#: Bytes of text that are cut at once; the arrays of a cut take some 40 times as much.
BATCH = 1 << 21


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, a slice begins here), both by state before and class of the position."""
    to = np.zeros((STATES, CLASSES), np.uint8)
    cut = np.ones((STATES, CLASSES), bool)
    for kind in (LETTER, SHORT, RV, EL):
        to[:, kind] = LETTERS
        cut[[LETTERS, LED], kind] = False
        to[PENDING, kind], cut[PENDING, kind] = FRESH, False
    to[QUOTE, SHORT], cut[QUOTE, SHORT] = FRESH, False
    to[QUOTE, [RV, EL]], cut[QUOTE, [RV, EL]] = PENDING, False
    to[:, NUMBER] = NUMBERS
    cut[[NUMBERS, LED], NUMBER] = False
    to[:, APOSTROPHE] = QUOTE
    to[:, OTHER] = OTHERS
    for kind in (APOSTROPHE, OTHER):
        to[[OTHERS, LED, QUOTE], kind] = OTHERS
        cut[[OTHERS, LED, QUOTE], kind] = False
    to[:, INNER], cut[GAP, INNER] = GAP, False
    to[:, LAST_SPACE] = LED
    to[:, LAST_WHITE] = FRESH
    to[:, RESET], cut[:, RESET] = FRESH, False
    return to, cut


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The closure of the class functions: element of a class, composition table, image by (element, state)."""
    to, _ = automaton()
    elements = [tuple(range(STATES)), *dict.fromkeys(tuple(to[:, c].tolist()) for c in range(CLASSES))]
    elements = list(dict.fromkeys(elements))
    at = 0
    while at < len(elements):
        for other in range(len(elements)):
            for first, second in ((elements[at], elements[other]), (elements[other], elements[at])):
                both = tuple(second[s] for s in first)
                if both not in elements:
                    elements.append(both)
        at += 1
    number = {e: i for i, e in enumerate(elements)}
    of_class = np.array([number[tuple(to[:, c].tolist())] for c in range(CLASSES)], np.uint16)
    compose = np.array([[number[tuple(b[s] for s in a)] for b in elements] for a in elements], np.uint16)
    return of_class, compose, np.array(elements, np.uint8)


def scan(items: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """The composition of all items up to each place, for an associative composition table."""
    n = len(items)
    if n <= LANE:
        out = np.array(items)
        for i in range(1, n):
            out[i] = compose[out[i - 1], items[i]]
        return out
    flat, width = compose.ravel(), np.uint32(compose.shape[1])
    lanes = -(-n // LANE)
    grid = np.zeros(lanes * LANE, np.uint16)  # element 0 is the identity
    grid[:n] = items
    grid = np.ascontiguousarray(grid.reshape(lanes, LANE).T)
    for i in range(1, LANE):
        grid[i] = flat[grid[i - 1] * width + grid[i]]
    before = scan(grid[-1], compose)[:-1]
    grid[:, 1:] = flat[before.astype(np.uint32)[None, :] * width + grid[:, 1:]]
    return np.ascontiguousarray(grid.T).ravel()[:n]


def class_array() -> np.ndarray:
    """The class of every code point, letters and numbers by the Unicode tables of the tokenizer library."""
    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000], np.uint32)
    every = points.tobytes().decode("utf-32-le")
    kinds = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (WHITE, r"\s")):
        bytewise = {bytes([i]): i for i in range(256)}
        encoding = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=bytewise, special_tokens={})
        found = encoding.decode_bytes(encoding.encode_ordinary(every)).decode()
        kinds[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    for kind, letters in ((SHORT, ONE_LETTER), (RV, BEFORE_E), (EL, BEFORE_L), (APOSTROPHE, "'"), (SPACE, " ")):
        kinds[[ord(c) for c in letters]] = kind
    return kinds


def read_ranks(path: str) -> bytes:
    """The rank file at ``path`` on the driver; it goes to the executors as a broadcast of its fixed size."""
    with open(path, "rb") as file:
        return file.read()


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Encodes batches of texts; one per worker and rank file, with a bounded cache of slices."""

    def __init__(self, ranks: bytes, kinds: np.ndarray):
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.kinds = kinds
        self.cache = Cache(lambda piece: pack(self.merge(piece)), 700_000)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: the adjacent pair of lowest rank is merged first, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n, none = len(piece), len(ranks)
        if n < 128:
            parts = [piece[i : i + 1] for i in range(n)]
            scores = [ranks.get(a + b, none) for a, b in pairwise(parts)]
            while scores and (least := min(scores)) < none:
                at = scores.index(least)
                made = parts[at] = parts[at] + parts.pop(at + 1)
                del scores[at]
                if at < len(scores):
                    scores[at] = ranks.get(made + parts[at + 1], none)
                if at:
                    scores[at - 1] = ranks.get(parts[at - 1] + made, none)
            return [ranks[p] for p in parts]
        end = list(range(1, n + 1))  # of the part that begins here; 0 once it is swallowed
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, stop = heapq.heappop(heap)
            b = end[a]
            if not b or b >= n or end[b] != stop:
                continue
            end[a], end[b] = stop, 0
            if stop < n:
                left[stop] = a
                if (r := ranks.get(piece[a : end[stop]])) is not None:
                    heapq.heappush(heap, (r, a, end[stop]))
            if (before := left[a]) >= 0 and (r := ranks.get(piece[before:stop])) is not None:
                heapq.heappush(heap, (r, before, stop))
        at, ids = 0, []
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def cuts(self, texts: list[bytes]) -> tuple[bytes, list[np.ndarray]]:
        """The joined texts, and for each text the byte places of its slices' begins and its end in them."""
        line = b"\n".join(texts) + b"\n"
        points = np.frombuffer(line.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        place = np.cumsum(width, dtype=np.int64) - width
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        at_stop = np.searchsorted(place, stops)

        kind = self.kinds[points]
        white = kind >= SPACE
        after = np.append(kind[1:], np.uint8(WHITE))
        following = np.append(points[1:], np.uint32(0))
        white_after = after >= SPACE
        white_after[at_stop - 1] = True  # the text ends; for an empty text this is a separator, reset below
        classes = np.where(white, np.where(white_after, INNER, np.where(kind == SPACE, LAST_SPACE, LAST_WHITE)), kind).astype(np.uint8)
        classes[(kind == RV) & (following != ord("e"))] = LETTER
        classes[(kind == EL) & (following != ord("l"))] = LETTER
        classes[at_stop] = RESET

        of_class, compose, image = monoid()
        prefix = scan(of_class[classes], compose)
        state = np.empty(len(classes), np.uint8)
        state[0], state[1:] = FRESH, image[prefix[:-1], FRESH]
        begins = automaton()[1][state, classes]
        begins[at_stop] = True
        marked = place[begins]
        ends = np.searchsorted(marked, stops)
        starts = np.concatenate([[0], ends[:-1] + 1])
        return line, [marked[a : b + 1] for a, b in zip(starts, ends)]

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, np.ndarray, list[bytes]]]:
        """For each text its ids as little-endian 32-bit numbers, its slices' byte places and each slice's ids."""
        line, places = self.cuts(texts)
        get, out = self.cache.__getitem__, []
        for marks in places:
            slices = marks.tolist()
            parts = [get(line[a:b]) for a, b in zip(slices, slices[1:])]
            out.append((b"".join(parts), marks - marks[0], parts))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(ranks: bytes, kinds: np.ndarray) -> Encoder:
    """The worker's encoder for a rank file; only the last one is kept."""
    key = hashlib.sha256(ranks).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks, kinds)
    return _ENCODERS[key]


def _encode_rows(rows: dict, ranks: bytes, kinds: np.ndarray) -> dict:
    done = encoder(ranks, kinds).encode(rows["text"])
    counts = [np.array([len(p) // 4 for p in parts], np.int64) for _, _, parts in done]
    return {name: rows[name] for name in rows if name != "text"} | {
        "ids": [np.frombuffer(ids, "<u4").astype(np.int32) for ids, _, _ in done],
        "slice_bytes": [marks.astype(np.int32) for _, marks, _ in done],
        "slice_ids": [np.concatenate([[0], np.cumsum(c)]).astype(np.int32) for c in counts],
    }


def _decode_rows(rows: dict, ranks: bytes, kinds: np.ndarray) -> dict:
    own = encoder(ranks, kinds)
    ids = [np.array(i or [], "<u4").tobytes() for i in rows["ids"]]
    return {"doc_id": rows["doc_id"], "text": [own.decode(i) for i in ids]}


def _digest_rows(rows: dict, ranks: bytes, kinds: np.ndarray) -> dict:
    own = encoder(ranks, kinds)
    ids = [done[0] for done in own.encode(rows["text"])]
    return {
        "doc_id": rows["doc_id"],
        "n_tokens": [len(i) // 4 for i in ids],
        "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
        "decoded_sha256": [hashlib.sha256(own.decode(i)).hexdigest() for i in ids],
    }


def _shared(rows: DataFrame, path: str) -> tuple:
    context = rows.sparkSession.sparkContext
    return context.broadcast(read_ranks(path)), context.broadcast(class_array())


def encode(docs: DataFrame, path: str, *carried: str) -> DataFrame:
    """doc_id, ``carried`` columns, ids, and the offsets of the slices.

    slice_bytes is the byte at which each slice begins, slice_ids the number of its first id; both
    have a last entry for the end, so any range of slices decodes by itself.
    """
    kept = docs.select(*[F.col(c) for c in carried]).schema
    own = "ids array<int>, slice_bytes array<int>, slice_ids array<int>"
    schema = ", ".join(["doc_id long", *[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], own])
    return by_batch(text_rows(docs, *carried), _encode_rows, schema, *_shared(docs, path), size=BATCH)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text's bytes of rows with ``ids``; null ids are an empty text."""
    return by_batch(encoded.select("doc_id", "ids"), _decode_rows, "doc_id long, text binary", *_shared(encoded, path), size=BATCH)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Every text encoded and decoded again: doc_id, n_tokens, SHA-256 of the ids and of the decoded bytes."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return by_batch(text_rows(docs), _digest_rows, schema, *_shared(docs, path), size=BATCH)
