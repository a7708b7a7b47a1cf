"""Token-ID output: concatenated id arrays with Elias-Fano document boundaries.

Texts are tokenized where they are read; only their ids are shuffled, once, into ordered ranges of
doc_id.  Each range becomes one file: the ids of its documents one after another (16 bits each if the
vocabulary allows, else 32), then two Elias-Fano sequences, the end of each document in that array and
the document ids, and a fixed-size tail that says where they begin.  ``select`` on the boundaries gives
a document's offset without a table of 64-bit offsets.  Writers keep one number per document in
memory; ids are streamed.  Files appear under their names only when whole, and the manifest, committed
last, holds each file's ids, from which a running sum gives the ids before it.

Tokenizing in pieces: in byte-level BPE every piece that begins at a single space after a word is
merged on its own, so a text is the concatenation of its pieces.  A slice of texts (bounded by bytes) is
split and its pieces dictionary-encoded in Arrow; only distinct pieces are tokenized, and the ids of the
texts are taken from the dictionary by index, some texts at a time.  Short pieces that repeat within a slice are kept for the next,
in a store of bounded size.  Texts where a space touches other white space on both sides, or that hold
a special token, are encoded whole.

Defined results: null and empty texts hold only the end id; null doc_ids come first, repeated doc_ids
follow each other ordered by their ids.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import materialize, range_of, range_starts, scratch, slices, table
from tillwise.llm.elias_fano import EliasFano
from tillwise.llm.files import AtomicFile, filesystem

MANIFEST = "bucket int, file string, docs long, ids long, bytes long"
TAIL = "<8sBQQQQ"  # magic, bytes an id, null doc ids, ids, bytes of: boundaries, doc ids
MAGIC = b"EFIDS001"
DOCS_PER_FILE = 20_000
SLICE_BYTES = 16 << 20     # text split at a time
PIECES_AT_ONCE = 1 << 18  # pieces whose ids are put together at a time
KEPT_PIECES = 100_000     # repeated pieces kept from slice to slice
KEPT_CHARS = 32           # the longest of them

SPACES = r"[\x00-\x20\x7f-\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"  # white space and controls
UNSAFE = f"{SPACES} (?:{SPACES}|\\z)"
MARKS = (".", ",")
LINE_BREAK = re.compile("(.*[^\\s\\x00-\\x1f\\x7f-\\xa0])\n([^\\s\\x00-\\x1f\\x7f-\\xa0].*)")


class _Pieces(dict):
    """Ids of pieces by text, as bytes.

    ``lead`` stands before each piece when it is encoded: a space, or nothing at the start of a line.
    A word with one closing mark, and two pieces around a line break, are put together from parts, as
    the tokenizer itself cuts there.
    """

    def __init__(self, encode, lead: str, dtype):
        super().__init__()
        self.encode, self.lead, self.dtype = encode, lead, dtype
        self.marks = {m: self.ids(m, "") for m in ".,\n"}
        self.plain = self  # where the part after a line break is looked up

    def ids(self, piece: str, lead: str) -> bytes:
        return np.asarray(self.encode(lead + piece).ids, self.dtype).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if piece[-1:] in MARKS and piece[:-1].isalpha():
            found = self[piece[:-1]] + self.marks[piece[-1]]
        elif cut := broken_line(piece):
            found = self[cut[1]] + self.marks["\n"] + self.plain[cut[2]]
        else:
            found = self.ids(piece, self.lead)
        self[piece] = found
        return found

    def prime(self, words: list[str]) -> None:
        """Encode many new words in one call; each is a token group of its own between separators."""
        between = self.lead or "\n"
        coded = self.encode(self.lead + between.join(words))
        data, groups = np.asarray(coded.ids, self.dtype).tobytes(), np.asarray(coded.word_ids)
        step = 1 if self.lead else 2  # a line break is a group too
        if not len(groups) or groups[-1] != step * (len(words) - 1):
            return  # the tokenizer cuts these words differently: each is encoded when it is met
        width = self.dtype.itemsize
        cuts = width * np.searchsorted(groups, step * np.arange(len(words)), "left")
        ends = width * np.searchsorted(groups, step * np.arange(len(words)), "right")
        self.update((w, data[a:b]) for w, a, b in zip(words, cuts.tolist(), ends.tolist()))

    def prime_apart(self, pieces: list[str]) -> None:
        """Encode many pieces that may be several token groups each."""
        coded = self.encode([self.lead + p for p in pieces], True)
        data, groups = np.asarray(coded.ids, self.dtype).tobytes(), np.asarray(coded.word_ids)
        cuts = self.dtype.itemsize * np.searchsorted(groups, np.arange(len(pieces) + 1), "left")
        for piece, a, b in zip(pieces, cuts[:-1].tolist(), cuts[1:].tolist()):
            self[piece] = data[a:b]

    def settle(self, repeated: list[str], limit: int) -> None:
        """Forget all but the short pieces of ``repeated``, at most ``limit`` of them."""
        kept = {w: self[w] for w in repeated if len(w) <= KEPT_CHARS}
        self.clear()
        self.update(kept if len(kept) <= limit else dict(list(kept.items())[:limit]))


def broken_line(piece: str) -> re.Match | None:
    return LINE_BREAK.fullmatch(piece) if piece.count("\n") == 1 else None


class Encoder:
    """Token ids of texts as little-endian bytes, equal to encoding each text whole."""

    def __init__(self, path: str, limit: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.dtype, self.limit = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"), limit
        self.encode_whole = lambda text, cut=False: tokenizer.encode(text, is_pretokenized=cut, add_special_tokens=False)
        self.first = _Pieces(self.encode_whole, "", self.dtype)
        self.after = _Pieces(self.encode_whole, " ", self.dtype)
        self.after.plain = self.first

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_slice(pa.array(texts, pa.string())).to_pylist()

    def encode_slice(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text (null: none) and ``end``, as binary."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, UNSAFE)
        for mark in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, mark))
        done = self._in_pieces(pc.if_else(whole, "", texts), end)
        if not pc.any(whole).as_py():
            return done
        alone = [np.asarray(self.encode_whole(t.as_py()).ids, self.dtype).tobytes() + end if w else None
                 for t, w in zip(texts, whole.to_pylist())]
        return pc.if_else(whole, pa.array(alone, pa.large_binary()), done)

    def _in_pieces(self, texts: pa.Array, end: bytes) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.large_binary())
        pieces = pc.split_pattern(texts, " ")
        starts = pieces.offsets.to_numpy()
        starts, flat = starts - starts[0], pieces.flatten()
        docs = len(texts)
        heads = np.zeros(len(flat), bool)
        heads[starts[:-1]] = True
        coded = flat.filter(pa.array(~heads)).dictionary_encode()
        leads = flat.filter(pa.array(heads)).to_numpy(zero_copy_only=False).tolist()
        del pieces, flat, heads  # the codes stand for them
        found, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        self._prime(found)
        # Entries: distinct pieces, the first piece of each text, the end.
        entries = pa.array([*map(self.after.__getitem__, found), *map(self.first.__getitem__, leads), end], pa.large_binary())
        counts = np.bincount(codes, minlength=len(found))
        often = np.argsort(-counts, kind="stable")[:self.limit]   # the limit takes the most frequent
        self.after.settle([found[i] for i in often[counts[often] > 1]], self.limit)
        self.first.settle(leads[:self.limit], self.limit)
        words = len(found)
        del found, leads, counts, often
        done, at = [], 0
        while at < docs:  # texts of about PIECES_AT_ONCE pieces
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECES_AT_ONCE, "right")) - 1)
            done.append(_joined(entries, words, codes, starts, at, to))
            at = to
        return pa.concat_arrays(done)

    def _prime(self, found: list[str]) -> None:
        """Encode what new distinct pieces are made of, many in one call."""
        known, words, marked, odd, lines = self.after, [], set(), [], set()
        for piece in found:
            if piece in known:
                continue
            if piece.isalpha():
                words.append(piece)
            elif piece[-1:] in MARKS and piece[:-1].isalpha():
                marked.add(piece[:-1])
            elif cut := broken_line(piece):
                for part, new in ((cut[1], marked), (cut[2], lines)):
                    word = part[:-1] if part[-1:] in MARKS else part
                    if word.isalpha():
                        new.add(word)
            else:
                odd.append(piece)
        marked.difference_update(words, known)
        for pieces, new in ((known, [*words, *marked]), (self.first, list(lines.difference(self.first)))):
            for at in range(0, len(new), 120):
                pieces.prime(new[at:at + 120])
        for at in range(0, len(odd), 1000):
            known.prime_apart(odd[at:at + 1000])


def _joined(entries: pa.Array, words: int, codes: np.ndarray, starts: np.ndarray, at: int, to: int) -> pa.Array:
    """The ids of texts ``at`` to ``to``, put together from the entries of their pieces: ``words`` are the
    distinct pieces, ``starts`` where the pieces of each text begin, ``codes`` all but the first of each."""
    here, texts = starts[at:to + 1] - starts[at], np.arange(to - at)
    first, last = here[:-1] + texts, here[1:] + texts   # one end after each text before
    index = np.empty(int(here[-1]) + to - at, np.int32)
    inner = np.ones(len(index), bool)
    inner[first] = inner[last] = False
    index[inner] = codes[starts[at] - at:starts[to] - to]
    index[first], index[last] = words + at + texts, len(entries) - 1
    ids = entries.take(pa.array(index))
    offsets = np.frombuffer(ids.buffers()[1], np.int64, len(index) + 1)
    cuts = np.concatenate([offsets[:1], offsets[last + 1]])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(cuts), ids.buffers()[2]])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder, with the pieces it keeps, per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Views of a batch of about SLICE_BYTES of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(sizes), 0
    while at < len(batch):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to
        pa.default_memory_pool().release_unused()


def _tokenize(path: str, end_id: int, bounds: list[int]):
    schema = pa.schema([("bucket", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.asarray([end_id], enc.dtype).tobytes()
        points = np.asarray(bounds, np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = part.column("doc_id")
                bucket = range_of(ids, points)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), ids, enc.encode_slice(part.column("text"), end).cast(pa.binary())],
                    schema=schema)

    return run


def _write(folder: str, width: int):
    schema = pa.schema([("bucket", pa.int32()), ("file", pa.string()), ("docs", pa.int64()),
                        ("ids", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, bucket, ends, names, nulls, at = None, None, [], [], 0, 0

        def close() -> list[dict]:
            if out is None:
                return []
            bounds, ids = EliasFano.build(ends).to_bytes(), EliasFano.build(names).to_bytes()
            out.write(bounds + ids + struct.pack(TAIL, MAGIC, width, nulls, at, len(bounds), len(ids)))
            out.commit()
            return [{"bucket": bucket, "file": out.name, "docs": len(ends), "ids": at, "bytes": out.size}]

        for batch in slices(batches):
            done = []
            for b, doc_id, ids in zip(*[batch.column(c).to_pylist() for c in ("bucket", "doc_id", "ids")]):
                if b != bucket:
                    done += close()
                    out, bucket = AtomicFile(folder, f"part-{b:05d}.ids"), b
                    ends, names, nulls, at = [], [], 0, 0
                out.write(ids)
                at += len(ids) // width
                ends.append(at)
                if doc_id is None:
                    nulls += 1
                else:
                    names.append(doc_id)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if done := close():
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def write_token_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` (doc_id, text) to ``folder`` in ascending doc_id order; returns the manifest."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    buckets = int(max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // DOCS_PER_FILE)))
    bounds = range_starts(docs, "doc_id", buckets)
    ids = (docs.mapInArrow(_tokenize(tokenizer, end_id, bounds), "bucket int, doc_id long, ids binary")
           .repartitionById(len(bounds) + 1, "bucket").sortWithinPartitions("bucket", "doc_id", "ids"))
    width = Encoder(tokenizer).dtype.itemsize
    return materialize(ids.mapInArrow(_write(folder, width), MANIFEST), "ids-manifest")


class IdFile:
    """One written file: document ids, boundaries, and the ids of any document."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = struct.calcsize(TAIL)
        magic, self.width, self.nulls, self.n_ids, a, b = struct.unpack(TAIL, self.file.read_at(tail, size - tail))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token id file")
        data = self.file.read_at(a + b, size - tail - a - b)
        self.ends, self.doc_ids = EliasFano.from_bytes(data[:a]), EliasFano.from_bytes(data[a:])

    def __len__(self) -> int:
        return self.ends.n

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.get(i - 1) if i else 0), self.ends.get(i)

    def ids(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        return np.frombuffer(self.file.read_at((end - start) * self.width, start * self.width), f"<u{self.width}")


def _read(folder: str):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                part = IdFile(fs, f"{path}/{name}")
                names = [None] * part.nulls + part.doc_ids.decode().tolist()
                ends = part.ends.decode()
                starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crcs, at = [], 0
                while at < len(ends):  # some megabytes of ids at a time
                    to = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 21), "right")))
                    data = np.frombuffer(part.file.read_at(int(ends[to - 1] - starts[at]) * part.width,
                                                           int(starts[at]) * part.width), f"<u{part.width}")
                    wide = data.astype("<u4")
                    crcs += [zlib.crc32(wide[s:e]) for s, e in zip(starts[at:to] - starts[at], ends[at:to] - starts[at])]
                    at = to
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(starts + base, pa.int64()),
                     pa.array(ends - starts, pa.int64()), pa.array(crcs, pa.int64())], schema=schema)

    return run


def read_token_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files that the manifest names: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", "bucket", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    last = manifest.agg(F.max("bucket")).first()[0] or 0
    return files.repartitionById(last + 1, "bucket").select("file", "base").mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder = scratch(docs.sparkSession, "token-ids")
    return read_token_ids(write_token_ids(docs, folder, tokenizer), folder)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents"), default_tokenizer())
