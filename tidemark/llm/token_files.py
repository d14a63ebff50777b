"""Operator 9: token ids in binary files of patched frame-of-reference blocks.

Documents are range-partitioned and sorted by id; each partition becomes one file.  The ids
of its documents, each with an end id, are one stream that is cut into blocks.  A block
stores its smallest id, the differences to it packed at the width which a given percentile of
them needs, and an exception list (place, higher bits) for the rest.  The file's tail indexes
the block starts and the documents, so a range of ids is read by its blocks alone.

Layout (little-endian): blocks, then int64 block starts, then per document int64 id, uint8
"has an id" and int64 number of ids, then the footer.  A block: uint32 count, uint32
smallest id, uint8 width, uint16 number of exceptions, the packed bits, uint16 places,
uint32 higher bits.

Defined results: a null or empty text is its end id alone.  Rows without an id come first;
rows of one id are ordered by the hash of their text, and equal rows stay side by side.  An
empty table has no files and no rows.
"""

from __future__ import annotations

import json
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.bpe import byte_alphabet
from tidemark.llm.common import BATCH_BYTES, file_bytes, materialise, per_worker, slices, utf8_rows
from tidemark.llm.files import new_file, open_file

BLOCK, PERCENTILE, GROUP = 1024, 90, 128
MAGIC = b"PFORIDS1"
_FOOTER = struct.Struct("<qqqqI8s")          # blocks, ids, documents, where the index starts, block size, magic
_HEAD = struct.Struct("<IIBH")
MOST_TASKS = 50_000
# --- fixed values: the split pattern of byte-level tokenizer files ---
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed values ---


def _pair_rules() -> np.ndarray:
    """For two neighbouring bytes, flags: 1, a cut between them; 2, a cut before the first (a space
    that goes with the second); 4 and 8, the two halves of a cut behind a lone other white space."""
    kind = np.zeros(256, np.uint8)                # 0: bytes that no rule but that of spaces regards
    kind[:28] = kind[33:128] = 4
    for first, last, k in ((65, 90, 1), (97, 122, 1), (48, 57, 2), (9, 13, 3)):
        kind[first: last + 1] = k
    kind[32] = 3
    a, b = np.arange(256)[:, None], np.arange(256)[None, :]
    ka, kb = kind[:, None], kind[None, :]
    cut = (ka != kb) & (ka != 0) & (kb != 0) & (ka != 3) & ~((a == 39) & (kb == 1))
    solid = (kind != 0) & (kind != 3)
    rules = cut + 2 * ((a == 32) & (solid[None, :] | (b >= 0x80))) + 4 * (solid[:, None] & (kb == 3) & (b != 32)) + 8 * ((ka == 3) & (a != 32) & solid[None, :])
    return rules.astype(np.uint8).reshape(-1)


class ChunkEncoder:
    """Byte-level BPE of the tokenizers library, with a bounded memo of text parts.

    The library's split pattern takes a space together with the word behind it, so a text may be
    cut before every space that a non-space character follows.  Where the pattern stands in the
    file as it is, a text is also cut where a run of letters below U+0250, of ASCII digits or of
    other ASCII characters ends (but not behind an apostrophe, which may begin a contraction), and
    behind a single line end or tab.  No cut is made inside an added token.  The parts of many
    texts are found on their bytes at once; each different part is looked up once, and a new one
    goes to the library's model if it is a single word, else through the library."""

    LONGEST = 80

    def __init__(self, data: bytes, entries: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(data)
        pre = spec["pre_tokenizer"] or {}
        plain = spec["model"]["type"] == "BPE" and not spec["normalizer"] and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True)
        opening = "".join(sorted({regex.escape(t["content"][0]) for t in spec["added_tokens"]}))
        self.own = regex.compile(rf"[\x00-\u024F--[{opening}]]*" if opening else r"[\x00-\u024F]*", regex.V1).fullmatch if plain else (lambda part: None)
        self.plain = plain
        self.added = [t["content"].encode() for t in spec["added_tokens"]]
        #: Added tokens that regard what stands beside them leave no place to cut.
        self.whole = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec["added_tokens"])
        self.model = self.tokenizer.model
        self.split = regex.compile(_SPLIT).findall
        self.shown = {b: c for b, c in enumerate(byte_alphabet())}
        self.entries, self.young, self.old = entries, {}, {}
        rules = _pair_rules()
        self.rules = rules if plain else rules & 2

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            shown = word.replace(" ", self.shown[32])
        else:
            shown = word.encode().decode("latin-1").translate(self.shown)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _starts(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the parts of the texts begin; the texts are ``raw`` between ``bounds``."""
        n = len(raw)
        start = np.zeros(n + 1, bool)
        if n > 1 and not self.whole:
            seen = raw
            if self.plain:                        # letters of two bytes (U+00C0 to U+023F) count as letters
                at = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC8))
                at = at[at < n - 1]
                at = at[~((raw[at] == 0xC3) & ((raw[at + 1] == 0x97) | (raw[at + 1] == 0xB7)))]
                if len(at):
                    seen = raw.copy()
                    seen[at] = seen[at + 1] = 97
            rule = self.rules.take(seen[:-1].astype(np.uint16) << np.uint16(8) | seen[1:])
            start[1:n] = rule & 1
            start[2:n] |= (rule[1:] & 8 != 0) & (rule[:-1] & 4 != 0)
            space = np.flatnonzero(rule & 2)
            odd = np.flatnonzero(raw[space + 1] >= 0x80)
            if len(odd):
                one, two, three = (raw[np.minimum(space[odd] + k, n - 1)] for k in (1, 2, 3))
                blank = (((one == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((one == 0xE1) & (((two == 0x9A) & (three == 0x80)) | ((two == 0xA0) & (three == 0x8E))))
                         | ((one == 0xE2) & (((two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))) | ((two == 0x81) & (three == 0x9F))))
                         | ((one == 0xE3) & (two == 0x80) & (three == 0x80)))
                space = np.delete(space, odd[blank])
            last = np.zeros(n + 1, bool)
            last[bounds[1:]] = True               # a space at a text's end has nothing behind it
            start[space[~last[space + 1]]] = True
            data = raw.tobytes() if self.added else b""
            for token in self.added:
                at = data.find(token)
                while at >= 0:
                    start[at + 1: at + len(token)] = False
                    at = data.find(token, at + 1)
        start[bounds] = True
        return np.flatnonzero(start[:n])

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts, as little-endian uint32 bytes."""
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young
        young, old, own, split = self.young, self.old, self.own, self.split
        out = list(map(young.get, parts))
        new = []
        for i in [i for i, v in enumerate(out) if v is None]:
            part = parts[i]
            ids = old.get(part)
            if ids is None:
                text = part.decode()
                if self.plain and text.isascii() and (text[1:] if text[0] == " " else text).isalpha():
                    ids = self._word(text)
                elif own(text):
                    ids = b"".join(map(self._word, split(text)))
                else:
                    new.append(i)
                    continue
            out[i] = ids
            if len(part) <= self.LONGEST:
                young[part] = ids
        for at in range(0, len(new), 20_000):
            some = new[at: at + 20_000]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([parts[i].decode() for i in some], add_special_tokens=False)):
                out[i] = ids = array("I", e.ids).tobytes()
                if len(parts[i]) <= self.LONGEST:
                    young[parts[i]] = ids
        return out

    def encode_rows(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts whose UTF-8 is ``raw`` between ``bounds``, in one array, and the
        number of ids of each text."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds) - 1, np.int64)
        starts = self._starts(raw, bounds)
        cuts = np.append(starts, len(raw))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        found = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(size) - size
        which = coded.indices.to_numpy()
        length = size[which]
        end = np.cumsum(length)
        ids = flat[np.repeat(first[which] - end + length, length) + np.arange(int(end[-1]))]
        return ids, np.diff(np.append(0, end)[np.searchsorted(starts, bounds)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian uint32 bytes."""
        ids, counts = self.encode_rows(*utf8_rows(pa.array(texts, pa.large_string())))
        end = np.cumsum(counts)
        return [ids[b - n: b].tobytes() for b, n in zip(end.tolist(), counts.tolist())]


def pack(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids (whole blocks but for the last)."""
    out = []
    for at in range(0, len(ids), BLOCK * GROUP):
        part = ids[at: at + BLOCK * GROUP]
        full = len(part) // BLOCK * BLOCK
        tables = [part[:full].reshape(-1, BLOCK)] if full else []
        if full < len(part):
            tables.append(part[full:].reshape(1, -1))
        for t in tables:
            low = t.min(axis=1)
            diff = (t - low[:, None]).astype(np.uint32)
            size = t.shape[1]
            place = min(size - 1, size * PERCENTILE // 100)
            need = np.partition(diff, place, axis=1)[:, place]
            width = np.zeros(len(t), np.int64)
            while (wide := need >> width.astype(np.uint32) > 0).any():
                width[wide] += 1
            high = np.where(width[:, None] < 32, diff >> np.minimum(width, 31).astype(np.uint32)[:, None], 0)
            bodies: list[bytes] = [b""] * len(t)
            for w in np.unique(width).tolist():
                own = np.flatnonzero(width == w)
                bits = np.unpackbits(diff[own].astype("<u4").view(np.uint8).reshape(len(own), size, 4), axis=2, count=w, bitorder="little").reshape(len(own), -1)
                for i, row in zip(own.tolist(), np.packbits(bits, axis=1, bitorder="little") if w else np.zeros((len(own), 0), np.uint8)):
                    bodies[i] = row.tobytes()
            for i in range(len(t)):
                x = np.flatnonzero(high[i])
                out.append(_HEAD.pack(size, int(low[i]), int(width[i]), len(x)) + bodies[i] + x.astype("<u2").tobytes() + high[i][x].astype("<u4").tobytes())
    return out


def unpack(data: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``data``, in order."""
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(starts)
    groups: dict[tuple[int, int], list[int]] = {}
    heads = []
    for k, s in enumerate(starts):
        size, low, width, n = _HEAD.unpack_from(data, s)
        heads.append((size, low, width, n, s + _HEAD.size))
        groups.setdefault((size, width), []).append(k)
    for (size, width), own in groups.items():
        nbytes = (size * width + 7) // 8
        if width:
            packed = np.stack([np.frombuffer(data, np.uint8, nbytes, heads[k][4]) for k in own])
            bits = np.unpackbits(packed, axis=1, count=size * width, bitorder="little").reshape(len(own), size, width)
            values = np.zeros((len(own), size), np.uint32)
            for j in range(width):
                values |= bits[:, :, j].astype(np.uint32) << np.uint32(j)
        else:
            values = np.zeros((len(own), size), np.uint32)
        for row, k in zip(values, own):
            _, low, _, n, at = heads[k]
            if n:
                where = np.frombuffer(data, "<u2", n, at + nbytes)
                row[where] |= np.frombuffer(data, "<u4", n, at + nbytes + 2 * n) << np.uint32(width)
            out[k] = row + np.uint32(low)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class Writer:
    """One file; ids are written as soon as a group of blocks is full."""

    def __init__(self, out):
        self.out, self.at, self.n, self.held, self.held_ids = out, 0, 0, [], 0
        self.starts, self.docs, self.known, self.lengths = array("q"), array("q"), bytearray(), array("q")

    def add(self, doc: int | None, ids: bytes) -> None:
        self.add_rows(np.array([doc or 0]), np.array([doc is not None]), np.frombuffer(ids, "<u4"), np.array([len(ids) // 4]))

    def add_rows(self, docs: np.ndarray, known: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Documents with all their ids in one array; unknown ones have number 0."""
        self.docs.frombytes(docs.astype("<i8").tobytes())
        self.known += known.astype(np.uint8).tobytes()
        self.lengths.frombytes(counts.astype("<i8").tobytes())
        self.held.append(ids.astype("<u4", copy=False))
        self.held_ids += len(ids)
        if self.held_ids >= BLOCK * GROUP:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        n = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack(ids[:n]):
            self.starts.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.n += n
        self.held, self.held_ids = [ids[n:].copy()], len(ids) - n

    def close(self) -> None:
        self._flush(True)
        self.out.write(self.starts.tobytes() + self.docs.tobytes() + bytes(self.known) + self.lengths.tobytes()
                       + _FOOTER.pack(len(self.starts), self.n, len(self.docs), self.at, BLOCK, MAGIC))
        self.out.close()


class Reader:
    """One file: its documents, and any range of its ids by the blocks that hold it."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - _FOOTER.size)
        blocks, self.n, docs, self.end, self.block, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        file.seek(self.end)
        index = file.read(8 * blocks + 17 * docs)
        self.starts = np.append(np.frombuffer(index, "<i8", blocks), self.end)
        self.docs = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.known = np.frombuffer(index, np.uint8, docs, 8 * (blocks + docs)).astype(bool)
        self.lengths = np.frombuffer(index, "<i8", docs, 8 * blocks + 9 * docs)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, (stop - 1) // self.block + 1
        self.file.seek(int(self.starts[a]))
        data = self.file.read(int(self.starts[b] - self.starts[a]))
        return unpack(data, (self.starts[a:b] - self.starts[a]).tolist())[start - a * self.block: stop - a * self.block]

    def runs(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document number, ids, whether they end it) in order; long documents come in pieces."""
        step = self.block * GROUP
        have, base = np.zeros(0, np.uint32), 0
        for d, n in enumerate(self.lengths.tolist()):
            left = n
            while True:
                if not len(have) and left:
                    have = self.ids(base, min(base + step, self.n))
                    base += len(have)
                piece, have = have[:left], have[left:]
                left -= len(piece)
                yield d, piece, not left
                if not left:
                    break


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text: the more text, the fewer of its parts are different."""
    held, size = [], 0
    for b in slices(batches, "text"):
        own = b.column(2).nbytes
        if held and size + own > 2 * BATCH_BYTES:        # a very long text stays by itself
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(b)
        size += own
        if size >= BATCH_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def write_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and write the files.  Returns the written manifest (path, ids, documents,
    start: the ids of all files before)."""
    data = docs.sparkSession.sparkContext.broadcast(file_bytes(tokenizer_path))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.xxhash64(text).alias("hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc", "hash").sortWithinPartitions("doc", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, path, first = per_worker("chunks", data.value, ChunkEncoder), None, "", None
        for b in _joined(batches):
            if writer is None:
                path, out = new_file(folder, ".ids")
                writer, first = Writer(out), (b.column(0)[0].as_py(), b.column(1)[0].as_py())
            ids, counts = encoder.encode_rows(*utf8_rows(b.column(2)))
            docs = b.column(0)
            writer.add_rows(docs.fill_null(0).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False), np.insert(ids, np.cumsum(counts), end_id), counts + 1)
        if writer is not None:
            n = len(writer.docs)
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()), pa.array([writer.n], pa.int64()), pa.array([n], pa.int64())],
                                             names=["path", "doc", "hash", "ids", "documents"])

    manifest = materialise(ordered.mapInArrow(run, "path string, doc long, hash long, ids long, documents long"), "ids-manifest")
    # A row per file: the number of files is bounded by that of the partitions.
    before = Window.orderBy(F.col("doc").asc_nulls_first(), "hash").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(manifest.select("path", "ids", "documents", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long").alias("start")), "ids-manifest")


def read_documents(manifest: DataFrame, doc_id: str = "doc_id", full: bool = False) -> DataFrame:
    """Per document, from the files: its id, start, n_tokens and ids_crc32 (with ``full`` also ids)."""
    tasks = max(1, min(MOST_TASKS, manifest.count()))
    fields = f"`{doc_id}` long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if full else "")
    kinds = [pa.int64()] * 4 + ([pa.list_(pa.int32())] if full else [])
    names = [doc_id, "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with open_file(path) as file:
                    r = Reader(file)
                    out: list[list] = [[] for _ in kinds]
                    crc, own, at, size = 0, [], start, 0
                    for d, piece, ended in r.runs():
                        crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        if full:
                            own.append(piece.astype(np.int32))
                        if ended:
                            n = int(r.lengths[d])
                            for c, v in zip(out, (int(r.docs[d]) if r.known[d] else None, at, n, crc, np.concatenate(own) if full else None)):
                                c.append(v)
                            size += 32 + 4 * n * full
                            crc, own, at = 0, [], at + n
                            if size > 4 << 20:
                                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                                out, size = [[] for _ in kinds], 0
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return manifest.select("path", "start").repartition(tasks).mapInArrow(run, fields)
