"""Toxicity: disguised words are restored through a noisy channel, then the text is scored.

A disguised token (digits or signs for letters, letters drawn out, letters spaced or dotted apart)
becomes a lattice: at each character the letters it may stand for, one letter for a run of the same,
nothing or itself for a separator. A Viterbi search finds the likeliest word under a character trigram model
counted over all documents, with a cost for every change. Texts with their tokens restored are then
scored by Naive Bayes support vectors over words and their beginnings.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalflow.llm import linear, words
from vitalflow.llm.common import fold_of, text_of, worker_cache

CUT = 0.3
# fixed values: letters that signs and digits commonly stand for
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e",
}
SEPARATORS = ".-_*~'`"
#: Letters of the character model; all others count as one.
LETTERS = "abcdefghijklmnopqrstuvwxyzàâäáãåæçèéêëìíîïñòóôöõøùúûüýÿßœ"
#: Log-likelihood paid for each change the channel makes.
SIGN_COST, RUN_COST, KEEP_RUN_COST, JOIN_COST = 1.0, 0.7, 0.3, 2.5
_EDGE, _OTHER = len(LETTERS), len(LETTERS) + 1
_SIZE = len(LETTERS) + 2
_CODE = np.full(0x250, _OTHER, dtype=np.int64)
for _i, _c in enumerate(LETTERS):
    _CODE[ord(_c)] = _i
    if len(_c.upper()) == 1 and ord(_c.upper()) < len(_CODE):
        _CODE[ord(_c.upper())] = _i
for _c in " \t\n\r\x0b\x0c.,;:!?\"'()" + SEPARATORS:
    _CODE[ord(_c)] = _EDGE

_GAP = re.compile(rf"[\s{re.escape(SEPARATORS)}]+")
_STOPS = ".,;:?\"()" + SEPARATORS
_HIGH_SIGNS = [c.encode() for c in STANDS_FOR if ord(c) >= 128]
_PARTS = np.zeros(256, dtype=np.int64)
_PARTS[[ord(c) for c in SEPARATORS]] = 1
_COUNTED = np.zeros(256, dtype=np.int64)  # first bytes of what is surely a character of a piece
_COUNTED[[*range(65, 91), *range(97, 123), *range(0xC3, 0xE0)]] = 1
_KIND = np.zeros(256, dtype=np.uint8)  # 1 letter, 2 sign that stands for letters
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[ord(c) for c in STANDS_FOR if ord(c) < 128]] = 2
_SIGNS = "".join(re.escape(c) for c in STANDS_FOR)
_APART = re.escape(SEPARATORS)
_LETTER = r"[^\W\d_]"
_PIECE = rf"(?:[{_SIGNS}]|{_LETTER})"
# what may stand before and behind a run of letters apart from each other, besides white space
_BEFORE = rf"(?<![^\s()\[\]{{}}<>/,;:\"'«»“”„‘’])"
_BEHIND = rf"(?![^\s.,;:!?()\[\]{{}}<>/\"'«»“”„‘’…])"
#: Single letters or signs apart from each other, three or more: "i d i o t", "l.o.s.e.r", "(l  o  s  e  r)".
SPACED = re.compile(rf"{_BEFORE}{_PIECE}(?:[ \t{_APART}]+{_PIECE}){{2,}}{_BEHIND}")
#: Three or more pieces of one or two letters with white space between, one of them single: "i di ot".
PARTED = re.compile(rf"{_BEFORE}{_PIECE}{{1,2}}(?:[ \t]+{_PIECE}{{1,2}}){{2,}}{_BEHIND}")
_SINGLE = re.compile(rf"(?<!\S){_PIECE}(?!\S)")
#: Tokens end at white space and at punctuation that is neither a sign nor a separator.
BETWEEN = re.compile(r"([\s,;:?\"/\\<>\[\]{}=&#)«»“”„…]+)")
#: A sign next to a letter, a letter drawn out, or a separator between letters.
DISGUISED = re.compile(
    rf"[{_SIGNS}]{_LETTER}|{_LETTER}[0-9@$|+€]+(?![^\W_])|({_LETTER})\1\1|{_LETTER}[{_APART}]+{_LETTER}"
)
_CHANGED = re.compile(rf"[{_SIGNS}]|({_LETTER})\1\1")
#: Words and tokens that a worker remembers, and the longest of them.
REMEMBERED, LONGEST = 200_000, 40


def character_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(code, n): character trigrams of all documents, with runs of non-letters as one edge.

    Every task sums its texts before the shuffle; there are at most (letters + 2)**3 codes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                texts = batch.column(0).slice(at, 64).to_pylist()
                raw = " ".join(texts).encode("utf-32-le", "surrogatepass")
                points = np.frombuffer(raw, dtype=np.uint32)
                codes = np.where(points < len(_CODE), _CODE[np.minimum(points, len(_CODE) - 1)], _OTHER)
                keep = np.ones(len(codes), dtype=bool)
                keep[1:] = (codes[1:] != _EDGE) | (codes[:-1] != _EDGE)
                codes = np.concatenate([[_EDGE], codes[keep], [_EDGE]])
                if len(codes) > 2:
                    grams = (codes[:-2] * _SIZE + codes[1:-1]) * _SIZE + codes[2:]
                    total += np.bincount(grams, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["code", "n"])

    counted = docs.select(text_of(text).alias("text")).mapInArrow(work, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood of a letter after two others, smoothed by shorter contexts; float32 cube.

    What comes to the driver is bounded by the number of trigrams, whatever the corpus.
    """
    table = character_counts(docs, text).toPandas()
    counts = np.zeros(_SIZE**3)
    counts[table.code.to_numpy(dtype=np.int64)] = table.n.to_numpy(dtype=float)
    three = counts.reshape(_SIZE, _SIZE, _SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + _SIZE)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def _code(char: str) -> int:
    point = ord(char)
    return int(_CODE[point]) if point < len(_CODE) else _OTHER


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per character of a token, the strings it may stand for and what each costs.

    What stands between letters may be nothing or stay. It is nothing where one and the same parts
    all letters by white space; white space between longer pieces has a cost to go. Two equal letters
    stay where the token has no other sign of a disguise.
    """
    out: list[list[tuple[str, float]]] = []
    chars = token.lower()
    plain = not _CHANGED.search(chars)
    gaps = set(_GAP.findall(chars))
    longest = max(map(len, chars.split()), default=0) if any(map(str.isspace, chars)) else 0
    i = 0
    while i < len(chars):
        c = chars[i]
        if gap := _GAP.match(chars, i):
            i = gap.end()
            if not any(map(str.isspace, gap.group())):
                out.append([("", 0.0), (gap.group(), 0.0)])
            elif len(gaps) == 1 and longest == 1:
                out.append([("", 0.0)])
            else:
                out.append([("", JOIN_COST if longest > 1 else 0.0), (gap.group(), 0.0)])
            continue
        run = 1
        while i + run < len(chars) and chars[i + run] == c:
            run += 1
        i += run
        if c.isalpha():
            ways = [(c, RUN_COST if run > 1 else 0.0)]
            if run == 2 and plain:
                ways = [(c * 2, 0.0)]
            elif run > 1:
                ways.append((c * 2, KEEP_RUN_COST if run == 2 else RUN_COST))
        elif c in STANDS_FOR:
            ways = [(s, SIGN_COST) for s in STANDS_FOR[c]]
            if run > 1:
                ways += [(s * 2, SIGN_COST) for s in STANDS_FOR[c]]
        else:
            ways = [(c * run, 0.0)]
        out.append(ways)
    return out


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest word that the token disguises; equally likely ones by their order in the lattice.

    Time and memory grow with the token's length: a state holds its letters and the state before.
    """
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(_EDGE, _EDGE): (0.0, None)}
    for ways in lattice(token):
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        coded = [(letters, cost, [_code(c) for c in letters]) for letters, cost in ways]
        for (a, b), (score, before) in states.items():
            for letters, cost, codes in coded:
                total, x, y = score - cost, a, b
                for z in codes:
                    if z == _EDGE == y:
                        continue  # several are one edge
                    total += float(model[x, y, z])
                    x, y = y, z
                if (x, y) not in following or total > following[x, y][0]:
                    following[x, y] = (total, (letters, before) if letters else before)
        states = following

    def at_end(state: tuple[tuple[int, int], tuple]) -> float:
        (a, b), (score, _) = state
        return score + (float(model[a, b, _EDGE]) if b != _EDGE else 0.0)

    letters: list[str] = []
    link = max(states.items(), key=at_end)[1][1]
    while link is not None:
        letters.append(link[0])
        link = link[1]
    return "".join(reversed(letters))


def _suspicious(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents of a chunk may have a disguised token at all, by their bytes.

    All that `restored` would change are among them, and others.
    """
    n = len(data)
    if not n:
        return np.zeros(len(offsets) - 1, dtype=bool)
    kind = _KIND[data]
    letter = kind == 1
    high = data >= 128
    marks = []
    # a sign next to a letter; a non-ASCII sign
    sign = kind == 2
    marks.append(np.flatnonzero((sign[:-1] & letter[1:]) | (letter[:-1] & sign[1:])))
    for raw in _HIGH_SIGNS:
        if n >= len(raw):
            hit = data[: n - len(raw) + 1] == raw[0]
            for k in range(1, len(raw)):
                hit &= data[k : n - len(raw) + 1 + k] == raw[k]
            marks.append(np.flatnonzero(hit))
    # three equal characters of one to four bytes
    for size in (1, 2, 3, 4):
        if n >= 3 * size:
            same = (data[:-size] == data[size:]) & (letter[:-size] if size == 1 else high[:-size])
            marks.append(_all_of(same, 2 * size))
    # pieces: nothing but separators between two; three short ones in a row, one of them single
    starts, ends = words._runs(data, offsets, kind > 0)
    parting = np.concatenate([[0], np.cumsum(_PARTS[data])])
    inside = parting[starts[1:]] - parting[ends[:-1]] == starts[1:] - ends[:-1]
    marks.append(starts[:-1][inside & (starts[1:] > ends[:-1])])
    if len(starts) > 2:
        counted = np.concatenate([[0], np.cumsum(_COUNTED[data])])
        size = counted[ends] - counted[starts]
        short, single = size <= 2, size <= 1
        row = short[:-2] & short[1:-1] & short[2:] & (single[:-2] | single[1:-1] | single[2:])
        marks.append(starts[:-2][row])
    places = np.sort(np.concatenate(marks))
    return np.searchsorted(places, offsets[1:]) > np.searchsorted(places, offsets[:-1])


def _all_of(marked: np.ndarray, length: int) -> np.ndarray:
    """Places from which `length` are marked."""
    places = np.flatnonzero(marked)
    places = places[: max(len(places) - length + 1, 0)][
        places[length - 1 :] - places[: max(len(places) - length + 1, 0)] == length - 1
    ]
    return places


def restored(text: str, model: np.ndarray, known: dict[str, str]) -> str:
    """The text with its disguised tokens restored; all else as it is."""

    def remembered(token: str, find: Callable[[str], str]) -> str:
        word = known.get(token)
        if word is None:
            word = find(token)
            if len(known) < REMEMBERED and len(token) <= LONGEST:
                known[token] = word
        return word

    def found(token: str) -> str:
        word = restore(token, model)
        return token if word == token.lower() else word

    def of_token(token: str) -> str:
        left = token.lstrip(_STOPS)
        body = left.rstrip(_STOPS + "!")
        if not DISGUISED.search(body):
            return token
        at = len(token) - len(left)
        return token[:at] + found(body) + left[len(body) :]

    def of_run(match: re.Match) -> str:
        run = match.group()
        return remembered(run, found) if match.re == SPACED or _SINGLE.search(run) else run

    text = PARTED.sub(of_run, SPACED.sub(of_run, text))
    parts = BETWEEN.split(text)
    parts[::2] = [remembered(p, of_token) if p else p for p in parts[::2]]
    return "".join(parts)


def extract(column: pa.Array) -> Iterator[np.ndarray]:
    """Indicators of a text: its words (runs of letters, A-Z in lower case) and their first four,
    five and six bytes."""
    shift = np.uint64(64 - (linear.FEATURES.bit_length() - 1))
    for _, _, data, offsets in words.chunks(column):
        codes, bounds = words.word_beginnings(data, offsets, _KIND == 1, (4, 5, 6))
        yield from linear.distinct_per_document((codes >> shift).astype(np.int64), bounds)


def with_restored(rows: DataFrame, model: Broadcast, name: str) -> DataFrame:
    """`rows` with disguised tokens of `text` restored by the character model of that name."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache(f"restored:{name}")
        for batch in batches:
            at = batch.schema.get_field_index("text")
            column = batch.column(at)
            for row, end, data, offsets in words.chunks(column):
                part = batch.slice(row, end - row)
                odd = np.flatnonzero(_suspicious(data, offsets))
                if len(odd):
                    texts = part.column(at).to_pylist()
                    for i in odd:
                        texts[i] = restored(texts[i], model.value, known)
                    columns = [*part.columns]
                    columns[at] = pa.array(texts, type=column.type)
                    part = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
                yield part

    return rows.mapInArrow(work, rows.schema)


def toxic_scores(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    cut: float = CUT,
    doc_id: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    A document is held out when crc32 of its id as text, modulo `folds`, is `held_fold`; labels of
    such documents are never learnt from. Only the text is scored; null counts as empty, and an
    empty text gets the score of no indicators. Rows that repeat are scored each. Without usable
    labels all scores are equal. An empty table gives no rows.
    """

    def held(number: Column) -> Column:
        return fold_of(number, folds) == held_fold

    # (letters + 2)**3 numbers, whatever the corpus
    model = docs.sparkSession.sparkContext.broadcast(character_model(docs, text))
    name = uuid.uuid4().hex
    learnt = linear.labelled_rows(docs, labels, "toxic", lambda i: ~held(i), doc_id, text)
    fitted = linear.fit(with_restored(learnt, model, name), extract, **{"least": 6, "band": 1.5, "cost": 0.1, **options})
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), held(F.col(doc_id)).alias("held_out"), text_of(text).alias("text")
    )
    return linear.scored(with_restored(rows, model, name), extract, fitted, cut)
