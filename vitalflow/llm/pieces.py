"""SentencePiece encoding by streaming Viterbi, and decoding.

The best segmentation of a text is found from left to right over the pieces of a model file and
their scores. Only the last `longest` positions can still be where the next piece starts, so that
window is all the scores that are kept; ids are committed as soon as the backpointers of every
position in it lead through one boundary. Pieces have the word mark only in front, so all paths
meet at each word's start: words are segmented on their own, those of a batch together, and what
was found for a word is remembered by the worker up to a bound.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalflow.llm.common import string_batches, text_of, worker_cache

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Added to the lowest score for a character without a piece, as in the public library.
UNKNOWN_PENALTY = 10.0
#: Words a worker remembers: the first ones, so the frequent ones. More cost time, no result.
REMEMBERED = 400_000
#: A longer stretch without a word start is segmented by the stream alone.
TOGETHER = 40
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.out: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.out[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.scores[piece] = float(model.get_score(i))
                self.ids[piece] = i
                self.out[i] = piece.replace(MARK, " ").encode()
        self.lowest = min(self.scores.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores))
        marked = [p for p in self.scores if MARK in p[1:] and p.strip(MARK)]
        if marked:
            raise ValueError("a piece has the word mark behind another character")
        # characters that no piece of two or more has: every path passes through both their sides
        inside = {c for p in self.scores if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r\x0b\x0c" if c not in inside)
        self.alone_lines = "\n" in alone
        self.split = re.compile(f" +[^ {alone}]*|[{alone}]|[^ {alone}]+" if alone else " +[^ ]*|[^ ]+")
        self._table()

    def _table(self) -> None:
        """The pieces by hash in two tables, each in one of its two places (cuckoo hashing), so that
        many substrings are looked up at once."""
        self.bits = 17
        slots = 1 << self.bits
        self.keys = np.zeros((2, slots), dtype=np.uint64)
        self.values = np.full((2, slots), -1, dtype=np.int32)
        self.score_of = np.full(len(self.out) + 1, -np.inf)  # the last place is for "no piece"
        for piece, i in self.ids.items():
            self.score_of[i] = self.scores[piece]
            key, value, side = int(piece_hash(piece)), i, 0
            for _ in range(1_000):
                at = self._place(key, side)
                held, self.keys[side, at] = int(self.keys[side, at]), key
                value, self.values[side, at] = int(self.values[side, at]), value
                if value < 0:
                    break
                key, side = held, 1 - side
            else:
                raise ValueError("the pieces do not fit the table")

    def _place(self, key: int, side: int) -> int:
        return (key >> (64 - self.bits)) if side == 0 else key & ((1 << self.bits) - 1)

    def found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids or -1, scores or -inf) of substrings by hash."""
        one = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        two = (hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        ids = np.where(self.keys[1][two] == hashes, self.values[1][two], -1)
        ids = np.where(self.keys[0][one] == hashes, self.values[0][one], ids)
        return ids, self.score_of[ids]


def piece_hash(text: str) -> np.uint64:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return np.uint64(_mix(h))


def _mix(h: int) -> int:
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return h ^ (h >> 31)




def shared_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once per worker."""
    cache = worker_cache("pieces")
    if path not in cache:
        cache[path] = Vocabulary(path)
    return cache[path]


class Stream:
    """Segments one stretch of characters with a window of `longest` positions.

    `feed` returns the ids committed by a character, `close` the rest. Of equally good paths the
    one whose last piece begins earliest wins.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        self.base = 0  # the last committed boundary
        self.text = ""  # characters since then
        self.best: list[float] = [0.0]  # per position since then
        self.back: list[int] = [0]

    def feed(self, char: str) -> list[int]:
        v = self.words
        self.text += char
        end = len(self.text)
        top, origin = -np.inf, end - 1
        for start in range(max(0, end - v.longest), end):
            score = v.scores.get(self.text[start:end])
            if score is None and start == end - 1:
                score = v.lowest
            if score is not None and self.best[start] + score > top:
                top, origin = self.best[start] + score, start
        self.best.append(top)
        self.back.append(origin)
        return self._commit() if end % v.longest == 0 else []

    def _commit(self) -> list[int]:
        """Ids up to the last boundary that every surviving path passes through."""
        end = len(self.text)
        live = set(range(max(0, end - self.words.longest + 1), end + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(self.back[furthest])
        meet = live.pop()
        if meet == 0:
            return []
        ids = self._ids(meet)
        self.text = self.text[meet:]
        base = self.best[meet]
        self.best = [b - base for b in self.best[meet:]]
        self.back = [max(0, b - meet) for b in self.back[meet:]]
        return ids

    def _ids(self, end: int) -> list[int]:
        cuts = []
        while end > 0:
            cuts.append((self.back[end], end))
            end = self.back[end]
        out: list[int] = []
        for start, stop in reversed(cuts):
            piece = self.text[start:stop]
            if piece in self.words.ids:
                out.append(self.words.ids[piece])
            else:
                out += [self.words.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return out

    def close(self) -> list[int]:
        return self._ids(len(self.text))


def stream_ids(chars: str, words: Vocabulary) -> list[int]:
    stream = Stream(words)
    out: list[int] = []
    for c in chars:
        out += stream.feed(c)
    return out + stream.close()


def together(stretches: Sequence[str], words: Vocabulary) -> list[bytes]:
    """Ids of many short stretches, two bytes each: the same recurrence, run over all stretches of
    one length at once."""
    out: list[bytes] = [b""] * len(stretches)
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(stretches):
        by_length.setdefault(len(s), []).append(i)
    by_length.pop(0, None)
    for length, members in by_length.items():
        if length > TOGETHER:
            for i in members:
                out[i] = packed(stream_ids(stretches[i], words))
            continue
        for at in range(0, len(members), 4_096):
            some = members[at : at + 4_096]
            joined = "".join([stretches[i] for i in some]).encode("utf-32-le", "surrogatepass")
            codes = np.frombuffer(joined, dtype=np.uint32).reshape(-1, length)
            for i, ids in zip(some, _together(codes, words), strict=True):
                out[i] = packed(stream_ids(stretches[i], words)) if ids is None else ids
    return out


def packed(ids: Sequence[int]) -> bytes:
    return np.array(ids, dtype="<u2").tobytes()


def _together(codes: np.ndarray, words: Vocabulary) -> Iterator[bytes | None]:
    """Ids per row; none for a row with a character that has no piece."""
    rows, length = codes.shape
    best = np.full((length + 1, rows), -np.inf)
    best[0] = 0.0
    back = np.zeros((length + 1, rows), dtype=np.int64)
    piece = np.full((length + 1, rows), -1, dtype=np.int64)
    wide = np.ascontiguousarray(codes.T).astype(np.uint64) + np.uint64(1)
    for start in range(length):
        h = np.zeros(rows, dtype=np.uint64)
        for end in range(start + 1, min(length, start + words.longest) + 1):
            h = h * _BASE + wide[end - 1]
            x = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            ids, scores = words.found(x ^ (x >> np.uint64(31)))
            if end == start + 1:
                scores = np.where(ids < 0, words.lowest, scores)
            total = best[start] + scores
            better = total > best[end]
            np.copyto(best[end], total, where=better)
            np.copyto(back[end], start, where=better)
            np.copyto(piece[end], ids, where=better)
    here, which = np.full(rows, length), np.arange(rows)
    steps = []
    while here.any():
        steps.append(np.where(here > 0, piece[here, which], -2))
        here = np.where(here > 0, back[here, which], 0)
    taken = np.array(steps)[::-1].T
    real = taken != -2
    strange = (taken == -1).any(axis=1).tolist()
    ends = (2 * np.cumsum(real.sum(axis=1))).tolist()
    flat = np.where(taken < 0, 0, taken)[real].astype("<u2").tobytes()
    begin = 0
    for end, odd in zip(ends, strange, strict=True):
        yield None if odd else flat[begin:end]
        begin = end


def _parts(text: str, words: Vocabulary) -> list[str]:
    """The stretches of a text between places that all paths pass through.

    A stretch has the spaces before it, but for a single one, which goes without saying unless the
    stretch is a line end and what follows it (`\n` in front).
    """
    if not text:
        return []
    if words.alone_lines and "\0" not in text:
        parts = text.replace("\n", " \n").split(" ")
        if "" not in parts and parts[0][0] != "\n":
            return parts
    split = words.split.findall(" " + text)
    # a single space in front is left out; the mark of "no space in front" is the line end or \0
    return [s[1:] if s[0] == " " and s[1:2] not in ("", " ", "\n", "\0") else "\0" + s for s in split]


def _ids_of(parts: Sequence[str], words: Vocabulary) -> list[bytes]:
    """Ids of stretches as `_parts` writes them."""
    plain, ends = [], []
    for s in parts:
        if s[0] == "\0":
            own = [s[1:]]
        elif s[0] == "\n":
            own = ["\n", s[1:]] if len(s) > 1 else ["\n"]
        else:
            own = [" " + s]
        plain += own
        ends.append(len(own))
    clean = [s.replace(" ", MARK) if MARK not in s else "" for s in plain]
    found = together(clean, words)
    for i, s in enumerate(plain):
        if MARK in s:
            found[i] = packed(_with_marks(s, words))
    out, at = [], 0
    for n in ends:
        out.append(found[at] if n == 1 else b"".join(found[at : at + n]))
        at += n
    return out


def encode_batch(texts: Sequence[str], words: Vocabulary, known: dict[str, bytes]) -> list[np.ndarray]:
    """Ids of each text, as the model's own rules for white space have it: a space in front, spaces
    as word marks, nothing else changed. An empty text has no ids.

    `known` remembers the ids of stretches, the first `REMEMBERED` different ones.
    """
    parted = [_parts(t, words) for t in texts]
    fresh = [p for p in set().union(*parted) if p not in known]
    more = dict(zip(fresh, _ids_of(fresh, words), strict=True)) if fresh else {}
    if len(known) + len(more) <= REMEMBERED:
        known.update(more)
        look = known
    else:
        look = {p: known[p] if p in known else more[p] for p in set().union(*parted)}
    find = look.__getitem__
    return [np.frombuffer(b"".join(map(find, parts)), dtype="<u2").astype(np.int32) for parts in parted]


def _with_marks(stretch: str, words: Vocabulary) -> list[int]:
    out: list[int] = []
    for i, part in enumerate(stretch.split(MARK)):
        if i:
            out += [words.byte_ids[b] for b in MARK.encode()]
        out += stream_ids(part.replace(" ", MARK), words)
    return out


def decode(ids: Sequence[int], words: Vocabulary) -> str:
    """The text of ids: pieces and byte pieces joined, without the space in front."""
    out = words.out
    joined = b"".join([out[i] for i in ids])
    return joined.decode("utf-8", "surrogatepass")[1:] if joined else ""


def encode_documents(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", check: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids, exact) of every document: its ids, and whether they decode to it.

    `model` is the path of a SentencePiece file with byte pieces, readable on every machine. Null
    counts as empty, which has no ids. Every text decodes to itself, whatever characters it has.
    Rows that repeat are encoded each; an empty table gives no rows; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared_vocabulary(model)
        known = worker_cache(f"piece-words:{model}")
        for part, texts in string_batches(batches, "text"):
            found = encode_batch(texts, words, known)
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            exact = [not check or decode(f.tolist(), words) == t for f, t in zip(found, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found))),
                    pa.array(exact),
                ],
                ["doc_id", "n_tokens", "ids", "exact"],
            )

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_tokens long, ids array<int>, exact boolean")
