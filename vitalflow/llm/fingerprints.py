"""Document fingerprints from prefix polynomial hashes.

For each of two primes the running sums of code points times powers of a base are kept. The hash of
any span is a difference of two of them, so two spans of equal length, in one text or two, are
compared in constant time, and the longest common extension of two places is found by binary search.
The fingerprint of a text is its length with the hash of the whole; two different texts of n code
points share one with a probability under (n / 2**31)**2 for bases drawn at random.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalflow.llm.common import text_of, worker_cache
from vitalflow.session import staged

# fixed values: two primes under 2**31 and a base for each
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_237_940_039, 742_938_285)
#: Common stretches of so many code points count wherever they lie in the two texts; shorter ones
#: count in order between the others, found by spans of these lengths.
SPAN, SHORTER = 20, (12, 6)


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of each base, kept by the worker and doubled when longer texts come."""
    cache = worker_cache("fingerprint-powers")
    if len(cache.get(0, ())) < n:
        for k, (prime, base) in enumerate(zip(PRIMES, BASES, strict=True)):
            table = cache.get(k, np.ones(1, dtype=np.uint64))
            while len(table) < n:
                step = np.uint64(pow(base, len(table), prime))
                table = np.concatenate([table, table * step % np.uint64(prime)])
            cache[k] = table
    return [cache[k][:n] for k in range(len(PRIMES))]


class Prefixes:
    """The prefix arrays of one text."""

    def __init__(self, text: str):
        raw = text.encode("utf-32-le", "surrogatepass")
        self.points = np.frombuffer(raw, dtype=np.uint32)
        self.sums = prefix_sums(self.points)
        self._spans: dict[int, np.ndarray] = {}
        self._parts: tuple[Prefixes, int, Prefixes, int] | None = None

    def __len__(self) -> int:
        return len(self.points)

    def spliced(self, keep: int, other: Prefixes, take: int) -> Prefixes:
        """The prefix arrays of this text's first `keep` code points and `take` of another's.

        What is kept needs no new sums; the other part's are those of the other text, moved on.
        """
        out = object.__new__(Prefixes)
        out.points = np.concatenate([self.points[:keep], other.points[:take]])
        out.sums = []
        for k, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            step = np.uint64(pow(BASES[k], keep, prime))
            moved = other.sums[k][1 : take + 1].astype(np.uint64) * step % p
            moved = (moved + np.uint64(self.sums[k][keep])) % p
            out.sums.append(np.concatenate([self.sums[k][: keep + 1], moved.astype(np.uint32)]))
        out._spans, out._parts = {}, (self, keep, other, take)
        return out

    def spans(self, length: int) -> np.ndarray:
        """The hashes of all spans of `length` code points, worked out once.

        The same span has the same hash in all texts, so those of a spliced text are those of its
        two parts, and a few across the seam.
        """
        if length not in self._spans:
            n = max(len(self) - length + 1, 0)
            if self._parts is None:
                found = _hashes_between(self, 0, n, length)
            else:
                own, keep, other, take = self._parts
                first = min(max(keep - length + 1, 0), n)
                second = min(max(take - length + 1, 0), n)
                seam = _hashes_between(self, first, n - second, length)
                found = np.concatenate([own.spans(length)[:first], seam, other.spans(length)[:second]])
            self._spans[length] = found
        return self._spans[length]

    def fingerprint(self) -> str:
        """Length and both hashes of the whole text; equal for equal texts, on any machine."""
        return f"{len(self):x}-" + "".join(f"{int(s[-1]):08x}" for s in self.sums)


def prefix_sums(points: np.ndarray) -> list[np.ndarray]:
    """Per prime the sums, modulo it, of (code point + 1) times powers, before each place and the end."""
    out = []
    wide = points.astype(np.uint64) + np.uint64(1)
    for prime, powers in zip(PRIMES, _powers(len(points)), strict=True):
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(wide * powers % np.uint64(prime), out=sums[1:])
        out.append((sums % np.uint64(prime)).astype(np.uint32))
    return out


def spans_equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether `length` code points of `a` from i on have the hash of those of `b` from j on."""
    for k, prime in enumerate(PRIMES):
        x = (int(a.sums[k][i + length]) - int(a.sums[k][i])) % prime
        y = (int(b.sums[k][j + length]) - int(b.sums[k][j])) % prime
        # both at the same power: the one further left is moved to the right
        if x * pow(BASES[k], max(j - i, 0), prime) % prime != y * pow(BASES[k], max(i - j, 0), prime) % prime:
            return False
    return True


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common stretch of `a` from i on and `b` from j on, by binary search."""
    low, high = 0, min(len(a) - i, len(b) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def common_ending(a: Prefixes, b: Prefixes, most: int) -> int:
    """Length of the longest common ending, `most` at most, by binary search."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, len(a) - middle, b, len(b) - middle, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _span_hashes(x: Prefixes, places: np.ndarray, length: int) -> np.ndarray:
    """The hashes of the spans of `length` code points from each place on, the same wherever they lie."""
    whole = x.spans(length)
    return (whole if len(places) == len(whole) else whole[places]).astype(np.uint64)


def _hashes_between(x: Prefixes, low: int, high: int, length: int) -> np.ndarray:
    """The hashes of the spans from the places `low` to `high` - 1 on."""
    prime, sums = np.uint64(PRIMES[0]), x.sums[0]
    if high <= low:
        return np.zeros(0, dtype=np.uint32)
    spans = sums[low + length : high + length].astype(np.uint64) + prime - sums[low:high]
    return (spans % prime * _inverse_powers(high)[low:high] % prime).astype(np.uint32)


def _inverse_powers(n: int) -> np.ndarray:
    cache = worker_cache("fingerprint-powers")
    table = cache.get("inverse", np.ones(1, dtype=np.uint64))
    while len(table) < n:
        step = np.uint64(pow(BASES[0], -len(table), PRIMES[0]))
        table = np.concatenate([table, table * step % np.uint64(PRIMES[0])])
    cache["inverse"] = table
    return table


def _in_both(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys of either side may be on the other one too: all that are, and few others."""
    bits = np.uint64((1 << max(12, (8 * max(len(left), len(right))).bit_length())) - 1)
    small = [(x & bits).astype(np.int64) for x in (left, right)]
    seen = np.zeros(int(bits) + 1, dtype=bool)
    seen[small[1]] = True
    in_left = np.flatnonzero(seen[small[0]])
    seen[:] = False
    seen[small[0][in_left]] = True
    return in_left, np.flatnonzero(seen[small[1]])


def _numbered(keys: np.ndarray) -> np.ndarray:
    """How many equal keys come before each."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.arange(len(keys)) - np.repeat(starts, sizes)
    return rank


def _alone(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys that no other equals, ascending, and where they are."""
    order = np.argsort(keys)
    ordered = keys[order]
    differs = np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])
    alone = differs[1:] & differs[:-1]
    return ordered[alone], order[alone]


def _met_once(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the keys are that both sides have exactly once."""
    (a, at_a), (b, at_b) = _alone(left), _alone(right)
    if not (len(a) and len(b)):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[place] == a
    return at_a[same], at_b[place[same]]


def _agreeing(
    a: Prefixes, i: np.ndarray, b: Prefixes, j: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places whose spans are equal code point by code point, by place in `a`."""
    steps = np.arange(length)
    same = (a.points[i[:, None] + steps] == b.points[j[:, None] + steps]).all(axis=1)
    order = np.argsort(i[same])
    return i[same][order], j[same][order]


def _rising(j: np.ndarray) -> np.ndarray:
    """Indices of a longest rising subsequence."""
    if len(j) < 2 or (j[1:] > j[:-1]).all():
        return np.arange(len(j))
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for k, value in enumerate(j.tolist()):
        place = bisect_left(ends, value)
        before.append(at[place - 1] if place else -1)
        if place == len(ends):
            ends.append(value)
            at.append(k)
        else:
            ends[place], at[place] = value, k
    out, k = [], at[-1]
    while k >= 0:
        out.append(k)
        k = before[k]
    return np.array(out[::-1])


def _mark(covered: np.ndarray, places: np.ndarray, length: int) -> None:
    if not len(places):
        return
    steps = np.zeros(len(covered) + 1, dtype=np.int32)
    steps[places] += 1  # no place comes twice
    steps[places + length] -= 1
    covered |= np.cumsum(steps[:-1]) > 0


def _free(covered: np.ndarray, low: int, high: int, length: int) -> np.ndarray:
    """Places from `low` on from which `length` code points before `high` are not covered."""
    if high - low < length:
        return np.zeros(0, dtype=np.int64)
    if not covered.any():
        return np.arange(low, high - length + 1)
    sums = np.concatenate([[0], np.cumsum(covered[low:high])])
    return low + np.flatnonzero(sums[length:] == sums[:-length])


def common_stretches(a: Prefixes, b: Prefixes, start: int, ending: int) -> int:
    """Code points in common between the first `start` and the last `ending` ones of both texts.

    Every span of `SPAN` code points is matched with an equal one of the other text, wherever it
    lies, as often as both have it. Of those that both have once, the longest sequence in one order
    divides the texts into gaps; in each gap shorter spans that both sides have there once are taken
    up in order, which divides it further. So a stretch by chance seldom counts.
    """
    ends = (len(a) - ending, len(b) - ending)
    covered = [np.zeros(len(x), dtype=bool) for x in (a, b)]
    marks = [np.zeros(0, dtype=np.int64)] * 2  # places that divide the texts into gaps
    for length in (SPAN, *SHORTER):
        places = [_free(c, start, end, length) for c, end in zip(covered, ends, strict=True)]
        if not (len(places[0]) and len(places[1])):
            continue
        keys = [_span_hashes(x, at, length) for x, at in zip((a, b), places, strict=True)]
        both = _in_both(*keys)
        if not (len(both[0]) and len(both[1])):
            continue
        places = [p[k] for p, k in zip(places, both, strict=True)]
        keys = [p[k] for p, k in zip(keys, both, strict=True)]
        if len(marks[0]):  # the numbers of the gaps are in the high bits
            gaps = [np.searchsorted(m, at).astype(np.uint64) for m, at in zip(marks, places, strict=True)]
            keys = [k + (g << np.uint64(31)) for k, g in zip(keys, gaps, strict=True)]
        if length == SPAN:
            ranked = [k << np.uint64(32) | _numbered(k).astype(np.uint64) for k in keys]
            _, left, right = np.intersect1d(*ranked, assume_unique=True, return_indices=True)
            i, j = _agreeing(a, places[0][left], b, places[1][right], length)
            _mark(covered[0], i, length)
            _mark(covered[1], j, length)
        left, right = _met_once(*keys)
        if not len(left):
            continue
        i, j = _agreeing(a, places[0][left], b, places[1][right], length)
        chosen = _rising(j)
        i, j = i[chosen], j[chosen]
        _mark(covered[0], i, length)
        _mark(covered[1], j, length)
        marks = [np.sort(np.concatenate([m, p])) for m, p in zip(marks, (i, j), strict=True)]
    return int(min(c.sum() for c in covered))


def likeness(a: Prefixes, b: Prefixes) -> float:
    """Share of the longer text that both have in common: 1 for equal texts (two empty ones too).

    What they begin and end with comes by longest common extensions, what they have in common in
    between by spans, wherever they lie. So a text with words changed here and there, or with
    passages of any length inserted, deleted, replaced or moved, keeps the share of what is left,
    and unrelated ones are near 0.
    """
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    start = common_extension(a, 0, b, 0)
    ending = common_ending(a, b, min(len(a), len(b)) - start)
    return (start + ending + common_stretches(a, b, start, ending)) / longer


def edited(own: Prefixes, following: Prefixes) -> Prefixes:
    """The text with its last floor(n / 2) code points replaced by as many first ones of the next."""
    half = len(own) // 2
    return own.spliced(len(own) - half, following, min(half, len(following)))


_ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(doc_id: int | None, own: Prefixes, following: Prefixes) -> tuple:
    new = edited(own, following)
    raw = new.points.tobytes().decode("utf-32-le", "surrogatepass")
    digest = hashlib.sha256(raw.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, len(own), digest, own.fingerprint(), new.fingerprint(),
        likeness(own, new), likeness(own, following),
    )


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), type=t) for c, t in zip(columns, kinds, strict=True)], names
    )


_NAMES = [f.split()[0] for f in _ROW.split(", ")]
_KINDS = [
    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike both and the next are.

    The documents are laid in order of id, nulls last; the next of the last is the first. Rows with
    one id follow each other by text. Null counts as empty; a lone document is next to itself. An
    empty table gives no rows; other columns are not read.

    Each task walks through a range of ids and compares neighbours. Only its first and last row
    have their neighbour elsewhere: two rows per task are written with their texts and joined.
    """
    known = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    place = F.col("doc_id").asc_nulls_last()
    # by the id alone: what Spark samples for the bounds comes to the driver
    ranged = known.repartitionByRange(place).sortWithinPartitions(place, "text")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        names = [*_NAMES, "part", "last", "text"]
        kinds = [*_KINDS, pa.int32(), pa.bool_(), pa.string()]
        empty = [None] * (len(_NAMES) - 1)
        before: tuple | None = None
        out: list[tuple] = []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, number in enumerate(ids):
                body = batch.column(1)[row].as_py()
                here = Prefixes(body)
                if before is None:
                    out.append((number, *empty, part, False, body))
                else:
                    out.append((*_compared(before[0], before[1], here), part, None, None))
                before = (number, here, body)
                if len(out) >= 500:
                    yield _columns(out, names, kinds)
                    out = []
        if before is not None:
            out.append((before[0], *empty, part, True, before[2]))
        yield _columns(out, names, kinds)

    walked = staged(ranged.mapInArrow(walk, f"{_ROW}, part int, last boolean, text string"), "prints")
    done = walked.filter("last is null").select(*_NAMES)
    edges = walked.filter("last is not null").select("doc_id", "part", "last", "text")
    # two rows a task: which task's first row follows which task's last one
    firsts = edges.filter("not last").select("part")
    by_part = Window.orderBy("part")
    follows = firsts.select(
        "part",
        F.coalesce(
            F.lead("part").over(by_part),
            F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("next_part"),
    )
    after = edges.filter("not last").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text")
    )
    pairs = edges.filter("last").join(follows, "part").join(after, "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            found = [_compared(i, Prefixes(a), Prefixes(b)) for i, a, b in rows]
            yield _columns(found, _NAMES, _KINDS)

    return done.unionByName(pairs.select("doc_id", "text", "next_text").mapInArrow(close, _ROW))
