"""Token ids in wavelet matrix files.

A shard's ids are written as one bit-plane per bit, highest first; each plane has the bit of every id
in an order that puts ids with a 0 before those with a 1, stably, plane by plane. Counts of ones
before every 512 bits give rank in constant time and select by a search. So any id, the number of
times an id occurs in a stretch, and the place of its k-th occurrence are found from one compressed
file, without unpacking the ids.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalflow.llm import words
from vitalflow.llm.common import make_folder, read_files, settings, text_of, worker_cache, write_file
from vitalflow.operators.ordered import running_before
from vitalflow.session import staged

MAGIC = b"WVLTMTX1"
BLOCK = 512
END_ID = 2
#: A file is closed with the document that brings it to so many ids; bounds a task's memory.
SHARD_IDS = 1 << 22
#: Bytes of text cut into pieces at once; a longer document is cut alone.
TEXT_BYTES = 1 << 23
#: Pieces of text a worker remembers the ids of: the first ones. More cost time, no result.
REMEMBERED = 600_000
_SEPARATOR = "\x01"


class Plane:
    """Bits with rank and select."""

    def __init__(self, bits: np.ndarray, size: int, ones: np.ndarray | None = None):
        self.packed, self.size = bits, size
        if ones is None:
            padded = np.zeros(-(-max(size, 1) // BLOCK) * BLOCK // 8, dtype=np.uint8)
            padded[: len(bits)] = bits
            counts = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
            ones = np.concatenate([[0], np.cumsum(counts)])
        self.ones = ones

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (7 - (i & 7))) & 1

    def rank1(self, i: int) -> int:
        """Ones before place i."""
        block = i // BLOCK
        bits = np.unpackbits(self.packed[block * BLOCK // 8 : -(-i // 8)])
        return int(self.ones[block]) + int(bits[: i - block * BLOCK].sum())

    def rank(self, bit: int, i: int) -> int:
        return self.rank1(i) if bit else i - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) of this bit."""
        starts = np.arange(len(self.ones), dtype=np.int64) * BLOCK
        before = self.ones if bit else np.minimum(starts, self.size) - self.ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        at = block * BLOCK
        bits = np.unpackbits(self.packed[at // 8 : (at + BLOCK) // 8])[: self.size - at]
        return at + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def all(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.size).astype(bool)


class WaveletMatrix:
    """A sequence of ids as bit-planes."""

    def __init__(self, size: int, planes: list[Plane], zeros: list[int]):
        self.size, self.planes, self.zeros = size, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = 16) -> WaveletMatrix:
        rest, planes, zeros = ids, [], []
        for k in range(bits - 1, -1, -1):
            one = ((rest >> rest.dtype.type(k)) & rest.dtype.type(1)).astype(bool)
            planes.append(Plane(np.packbits(one), len(ids)))
            low = rest[~one]
            zeros.append(len(low))
            rest = np.concatenate([low, rest[one]])
        return cls(len(ids), planes, zeros)

    def ids(self) -> np.ndarray:
        """All ids in order, plane by plane from the lowest bit up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        rest = np.zeros(self.size, dtype=kind)
        for depth, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1], strict=True)):
            one = plane.all()
            here = np.empty_like(rest)
            here[~one] = rest[:zeros]
            here[one] = rest[zeros:] | kind(1 << depth)
            rest = here
        return rest

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.bit(i)
            value = value << 1 | bit
            i = zeros + plane.rank1(i) if bit else plane.rank(0, i)
        return value

    def _narrow(self, value: int, low: int, high: int) -> tuple[int, int]:
        """The stretch of the last order that the occurrences of `value` in [low, high) take up."""
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = value >> (len(self.planes) - 1 - k) & 1
            low, high = plane.rank(bit, low), plane.rank(bit, high)
            if bit:
                low, high = low + zeros, high + zeros
        return low, high

    def count(self, value: int, low: int = 0, high: int | None = None) -> int:
        """How often `value` occurs among the ids from `low` up to before `high`."""
        begin, end = self._narrow(value, low, self.size if high is None else high)
        return end - begin

    def occurrence(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of `value`."""
        begin, end = self._narrow(value, 0, self.size)
        if not 0 <= k < end - begin:
            raise IndexError(k)
        at = begin + k
        for depth in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - depth) & 1
            at = self.planes[depth].select(bit, at - self.zeros[depth] if bit else at)
        return at


def to_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int = 16) -> bytes:
    """One file: header with the sizes of its parts, documents, planes, counts of ones."""
    matrix = WaveletMatrix.build(ids, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([i if i is not None else 0 for i in doc_ids], dtype="<i8")
    missing = np.array([i is None for i in doc_ids], dtype=np.uint8)
    parts = [known.tobytes(), missing.tobytes(), np.array(lengths, dtype="<i8").tobytes()]
    for plane in matrix.planes:
        parts += [plane.packed.tobytes(), plane.ones.astype("<i8").tobytes()]
    packed = [pack(p) for p in parts]
    header = json.dumps(
        {"ids": len(ids), "documents": len(doc_ids), "zeros": matrix.zeros, "parts": [len(p) for p in packed]}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *packed])


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(document ids, numbers of token ids, matrix) of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet matrix file")
    at = 12 + struct.unpack("<I", data[8:12])[0]
    header = json.loads(data[12:at])
    unpack = zstandard.ZstdDecompressor().decompress
    parts = []
    for size in header["parts"]:
        parts.append(unpack(data[at : at + size]))
        at += size
    known, missing = np.frombuffer(parts[0], "<i8").tolist(), np.frombuffer(parts[1], np.uint8)
    doc_ids = [None if m else i for i, m in zip(known, missing, strict=True)]
    planes = [
        Plane(np.frombuffer(b, np.uint8), header["ids"], np.frombuffer(o, "<i8"))
        for b, o in zip(parts[3::2], parts[4::2], strict=True)
    ]
    matrix = WaveletMatrix(header["ids"], planes, header["zeros"])
    return doc_ids, np.frombuffer(parts[2], "<i8"), matrix


class Encoder:
    """Ids of texts by the tokenizers library, remembered per piece between white space.

    The tokenizer drops white space and never joins what lies on both sides of it, so a text's ids
    are those of its pieces in a row. A batch's texts are cut and its distinct pieces found by Arrow.
    A piece that begins with letters which the library maps one by one has the ids of those letters,
    straight from the library's model, and then those of the rest. What is left is encoded many at a
    time, with a sign between whose id no other piece has.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.separator,) = self._encode(_SEPARATOR)
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = self._letters()
        signs = re.escape("".join(map(chr, self.letters)))
        # up to the end or a visible sign of ASCII that is no letter: the library parts them there
        self.beginning = re.compile(f"[{signs}]++(?=[!-~]|\\Z)").match if self.letters else lambda piece: None

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _letters(self) -> dict[int, str]:
        """Letters of Latin-1 and what the model gets for each; none if that is not one by one."""
        normal, parts = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is None or parts is None:
            return {}
        out = {}
        for letter in filter(str.isalpha, map(chr, range(256))):
            found = parts.pre_tokenize_str(normal.normalize_str(letter))
            if len(found) == 1:
                out[ord(letter)] = found[0][0]
        ascii_letters = set(map(ord, string.ascii_letters))
        every = "".join(map(chr, out))
        found = parts.pre_tokenize_str(normal.normalize_str(every))
        added = [t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values()]
        one_by_one = [t for t, _ in found] == [every.translate(out)]
        return out if one_by_one and ascii_letters <= set(out) and not any(ord(c) in out for c in added) else {}

    def _pieces(self, fresh: list[str]) -> list[bytes]:
        """Ids of distinct pieces not met yet."""
        words, rests = [], []
        beginning, letters = self.beginning, self.letters
        for piece in fresh:
            found = beginning(piece)
            if found is None:
                words.append("")
                rests.append(piece)
            else:
                word = found.group()
                words.append(word.translate(letters))
                rests.append(piece[len(word) :])
        tails = {rest: self.known.get(rest) for rest in set(rests)}
        tails.update(self._encoded([rest for rest, ids in tails.items() if ids is None]))
        room = REMEMBERED - len(self.words)
        of_word = self.words if len(set(words)) <= room else dict.fromkeys(words)
        tokenize, pack = self.model.tokenize, struct.pack
        out = []
        for word, rest in zip(words, rests, strict=True):
            own = of_word.get(word)
            if own is None:
                own = self.words.get(word)
                if own is None:
                    ids = [token.id for token in tokenize(word)] if word else []
                    own = pack(f"<{len(ids)}H", *ids)
                of_word[word] = own
            out.append(own + tails[rest] if rest else own)
        return out

    def _encoded(self, pieces: list[str]) -> dict[str, bytes]:
        out = {p: np.array(self._encode(p), "<u2").tobytes() for p in pieces if _SEPARATOR in p}
        plain = [p for p in pieces if _SEPARATOR not in p]
        between = f" {_SEPARATOR} "
        for at in range(0, len(plain), 4_000):
            some = plain[at : at + 4_000]
            ids = np.array(self._encode(between.join(some)), dtype="<u2")
            cuts = np.flatnonzero(ids == self.separator).tolist()
            raw = ids.tobytes()
            for piece, begin, end in zip(some, [-1, *cuts], [*cuts, len(ids)], strict=True):
                out[piece] = raw[2 * begin + 2 : 2 * end]
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian two-byte ids of each text of a column without nulls."""
        parted = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = parted.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        made = [*map(self.known.get, pieces)]
        fresh = [i for i, ids in enumerate(made) if ids is None]
        more = self._pieces([pieces[i] for i in fresh])
        remember = len(self.known) + len(fresh) <= REMEMBERED
        for i, ids in zip(fresh, more, strict=True):
            made[i] = ids
            if remember:
                self.known[pieces[i]] = ids
        found = pa.array(made, pa.large_binary())
        ids = found.take(coded.indices)
        _, places, data = ids.buffers()
        starts = np.frombuffer(places, np.int64)[ids.offset : ids.offset + len(ids) + 1]
        counts = pc.list_value_length(parted).to_numpy()
        bounds = starts[np.concatenate([[0], np.cumsum(counts)])].tolist()
        raw = b"" if data is None else memoryview(data)
        return [bytes(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _encoder(path: str) -> Encoder:
    cache = worker_cache("word-encoders")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write every document's ids and `end_id` in order of id; one row per file, in file order.

    Rows: `path`, `part` and `number` (the order of the files), `documents`, `ids`. Null ids come
    last, rows with one id follow each other by text; null counts as empty. Only the files of the
    attempts that succeeded are in the rows. An empty table gives none.
    """
    known = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    place = F.col("doc_id").asc_nulls_last()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        held: list[bytes] = []
        size = 0
        end = np.array([end_id], dtype="<u2").tobytes()

        def close() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(held), dtype="<u2")
            data = to_bytes(ids, [len(h) // 2 for h in held], flat)
            path = write_file(folder, f"{part:06d}-{number:06d}.wm", data)
            row = {"path": [path], "part": [part], "number": [number], "documents": [len(ids)], "ids": [len(flat)]}
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for batch in batches:
            for at, until, _, _ in words.chunks(batch.column(1), TEXT_BYTES):
                some = batch.slice(at, until - at)
                for i, raw in zip(some.column(0).to_pylist(), encoder.encode(some.column(1)), strict=True):
                    ids.append(i)
                    held.append(raw + end)
                    size += len(raw) // 2 + 1
                    if size >= shard_ids:
                        yield close()
                        ids, held, size, number = [], [], 0, number + 1
        if ids:
            yield close()

    schema = pa.schema(
        [("path", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("documents", pa.int64()), ("ids", pa.int64())]
    )
    make_folder(folder)
    # by the id alone: what Spark samples for the bounds comes to the driver
    rows = known.repartitionByRange(place).sortWithinPartitions(place, "text")
    fields = "path string, part int, number int, documents long, ids long"
    return staged(rows.mapInArrow(work, fields), "token-files")


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) per document out of the files; `ids` as four-byte numbers."""
    return _documents(files, folder, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def token_file_sums(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document out of the files."""
    return _documents(files, folder, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4")), pa.int64())


def _documents(files: DataFrame, folder: str, field: str, of, kind: pa.DataType) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, lengths, matrix = from_bytes(content.as_py())
                ids = matrix.ids()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                made = [of(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(doc_ids), pa.string()),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(begins),
                        pa.array(lengths),
                        pa.array(made, kind),
                    ],
                    ["path", "doc_id", "offset", "n_tokens", field.split()[0]],
                )

    spark = files.sparkSession
    name = F.substring_index("path", "/", -1).alias("name")
    placed = running_before(files, [], ["part", "number"], first=("sum", F.col("ids"))).select(name, "first")
    # few files at once: each is a row of some megabytes
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="2"):
        read = read_files(files, "path", folder).mapInArrow(
            work, f"path string, doc_id long, offset long, n_tokens long, {field}"
        )
        rows = staged(read, "token-documents")
    joined = rows.withColumn("name", F.substring_index("path", "/", -1)).join(placed, "name")
    start = (F.col("first") + F.col("offset")).alias("start")
    return joined.select("doc_id", start, "n_tokens", field.split()[0])
