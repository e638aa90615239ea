"""Token ids in files of length-delimited records, with an index of offsets for reading in any order."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centerline.llm.checksums import Crc32c
from centerline.llm.common import batch_of, document_columns, in_blocks, mapped, worker_store
from centerline.llm.tokens import byte_characters
from centerline.sources.ranges import open_fs

# Kinds of bytes. White space beyond ASCII, and what some library might count as such, is among the unclear ones.
LETTER, NUMBER, MARK, QUOTE, SPACE, FEED, UNCLEAR = range(7)
LINES = 400  # units that the library gets at a time
CACHE_BYTES = 64 << 20  # of parts that a worker remembers

_HEAD = np.dtype([("doc_id", "<i8"), ("known", "u1")])
_FRAME = 12  # the length and its checksum stand before a record, its own checksum of 4 bytes behind it
_INDEX = "part int, file string, doc_id long, offset long, length long, n_tokens long, before long"
_RECORD = "part int, doc_id long, before long, ids array<int>"
_CHECKED = "part int, doc_id long, before long, n_tokens long, ids_crc32 long"
READ_BYTES, GAP = 8 << 20, 1 << 16


def _kinds() -> np.ndarray:
    """The kind of each byte. Bytes from C3 to C9 lead letters of two bytes (U+00C0 to U+027F, but for two signs)."""
    kinds = np.full(256, MARK, dtype=np.uint8)
    kinds[0x80:] = UNCLEAR
    kinds[0xC3:0xCA] = LETTER
    kinds[0x1C:0x20] = UNCLEAR
    kinds[list(b"\t\n\x0b\x0c\r")] = FEED
    for kind, own in ((SPACE, b" "), (QUOTE, b"'"), (NUMBER, b"0123456789")):
        kinds[list(own)] = kind
    kinds[[b for b in range(128) if chr(b).isalpha()]] = LETTER
    return kinds


def _cuts() -> np.ndarray:
    """Whether a pre-token always begins between two bytes of these kinds, by ``8 * first + second``."""
    cut = np.zeros((8, 8), dtype=bool)
    cut[:SPACE, SPACE:UNCLEAR] = True
    cut[UNCLEAR, SPACE:UNCLEAR] = True  # unless the first ends white space, see ``Cutter``
    cut[LETTER, [NUMBER, MARK, QUOTE]] = True
    cut[NUMBER, [LETTER, MARK, QUOTE]] = True
    cut[MARK, [LETTER, NUMBER]] = True
    cut[QUOTE, NUMBER] = True  # letters behind a quote may be one pre-token with it
    return cut.ravel()


class Cutter:
    """Where texts can be cut so that the parts have the pre-tokens of the whole, by the byte-level pattern

    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``

    Cuts are made where a pre-token begins whatever stands around, and nowhere else, so a part may hold several. A part
    of ASCII without quote, and one of letters, is one pre-token. In white space before something else, the last
    character stands by itself or with what follows.
    """

    def __init__(self) -> None:
        self.kinds, self.cuts = _kinds(), _cuts()
        spaces = [c.encode() for c in map(chr, range(0x80, 0x10000)) if c.isspace() or c in "\u180e\u200b\ufeff"]
        self.odd2, self.odd3 = (
            np.array([int.from_bytes(c, "big") for c in spaces if len(c) == n], dtype=np.uint32) for n in (2, 3)
        )

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The first byte of each part of the texts that begin at ``offsets[:-1]``; none of these is empty."""
        kind = self.kinds[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
        second = data[lead + 1]
        letter = (data[lead] != 0xC3) | ((second != 0x97) & (second != 0xB7))
        kind[lead + 1] = np.where(letter, LETTER, UNCLEAR)
        kind[lead[~letter]] = UNCLEAR
        pair = kind[:-1] << 3 | kind[1:]
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = self.cuts[pair]
        begin = np.zeros(len(data) + 1, dtype=bool)
        begin[offsets] = True
        unclear = np.flatnonzero((pair == (UNCLEAR << 3 | SPACE)) | (pair == (UNCLEAR << 3 | FEED)))
        if len(unclear):
            code = data[np.maximum(unclear[:, None] - [2, 1, 0], 0)].astype(np.uint32) @ np.array([1 << 16, 1 << 8, 1], np.uint32)
            odd = np.isin(code & 0xFFFF, self.odd2) | np.isin(code, self.odd3) | (code & 0xFF < 0x80)
            cut[unclear[odd] + 1] = False
        white = (kind == SPACE) | (kind == FEED)
        last = np.flatnonzero(white[:-2] & white[1:-1] & (kind[2:] < SPACE)) + 1
        cut[last[~begin[last + 1]]] = True
        fed = np.flatnonzero((pair >> 3 == FEED) & (kind[1:] < SPACE))
        cut[fed + 1] = cut[fed] | begin[fed]
        cut |= begin
        cut[-1] = False
        return np.flatnonzero(cut)


class Encoder:
    """Ids of whole texts, as the library gives them; parts of texts that are equal are encoded once.

    Texts are cut by ``Cutter`` if the vocabulary is a byte-level one with the usual pattern. With any other, and where a
    special string stands in a text, the library gets the text as it is.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        kind = json.loads(self.tokenizer.to_str())
        pre = kind["pre_tokenizer"] or {}
        self.cutter = Cutter() if (
            kind["normalizer"] is None and kind["model"]["type"] == "BPE" and not kind["model"]["dropout"]
            and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]
        ) else None
        self.characters = byte_characters()
        newline = self._whole(["\n"])[0]
        self.newline = newline[0] if len(newline) == 1 else None
        # Parts by their ids, and the block that each was seen in last. Of more than ``limit``, or
        # ``CACHE_BYTES``, the latest stay, half as many.
        self.limit = limit
        self.units, self.codes = pa.array([], pa.binary()), pa.array([], pa.binary())
        self.seen, self.turn = np.zeros(0, dtype=np.int32), 0

    @classmethod
    def shared(cls, path: str) -> "Encoder":
        """One for each Python worker."""
        store = worker_store()
        key = f"encoder {path}"
        if key not in store:
            store[key] = cls(path)
        return store[key]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.type) for e in found]

    def _merged(self, tokens: list[str]) -> list[bytes]:
        """The ids of pre-tokens, spelled in the characters that stand for bytes."""
        merge, out = self.tokenizer.model.tokenize, []
        for at in range(0, len(tokens), 16 * LINES):
            found = list(map(merge, tokens[at:at + 16 * LINES]))
            data = np.array([t.id for own in found for t in own], dtype=self.type).tobytes()
            stops = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) * self.type.itemsize).tolist()
            out += [data[a:z] for a, z in zip([0, *stops], stops)]
        return out

    def _lines(self, units: list[str]) -> list[bytes]:
        """The ids of parts without white space but a space in front, many in a text: a line's end is a token of its own."""
        out, width = [], self.type.itemsize
        groups = [units[i:i + LINES] for i in range(0, len(units), LINES)]
        for own, ids in zip(groups, self._whole(["\n".join([*g, ""]) for g in groups])):
            stops = (np.flatnonzero(ids == self.newline) * width).tolist()
            data = ids.tobytes()
            out += [data[a:z] for _, a, z in zip(own, [0, *(z + width for z in stops)], stops, strict=False)]
        return out

    def _learn(self, units: pa.Array) -> list[bytes]:
        """The ids of parts that were not seen before."""
        texts = units.cast(pa.string())
        plain = pc.and_not(pc.ascii_is_printable(texts), pc.match_substring(texts, "'")).to_numpy(zero_copy_only=False)
        tokens = pc.replace_substring(texts, " ", self.characters[ord(" ")]).to_pylist()
        merged, lines, alone = np.flatnonzero(plain).tolist(), [], []
        others = dict(zip(np.flatnonzero(~plain).tolist(), texts.filter(pa.array(~plain)).to_pylist()))
        for k, text in others.items():
            if (text[1:] if text[0] == " " else text).isalpha() and max(text) < "\u0280":
                tokens[k] = text.encode().decode("latin-1").translate(self.characters)
                merged.append(k)
            elif self.newline is not None and text.isprintable() and " " not in text[1:] and text != " ":
                lines.append(k)
            else:
                alone.append(k)
        out: list[bytes] = [b""] * len(tokens)
        for own, found in (
            (merged, self._merged([tokens[k] for k in merged])),
            (lines, self._lines([others[k] for k in lines])),
            (alone, [ids.tobytes() for ids in self._whole([others[k] for k in alone])] if alone else []),
        ):
            for k, ids in zip(own, found, strict=True):
                out[k] = ids
        return out

    def _coded(self, units: pa.Array) -> pa.Array:
        """The ids of each part. Parts known and met are numbered together, so that only new ones are looked at."""
        known = len(self.units)
        numbered = pa.concat_arrays([self.units, units]).dictionary_encode()
        which = numbered.indices.slice(known)
        self.turn += 1
        if len(numbered.dictionary) > known:
            new = self._learn(numbered.dictionary.slice(known))
            self.units = numbered.dictionary
            self.codes = pa.concat_arrays([self.codes, pa.array(new, pa.binary())])
            self.seen = np.concatenate([self.seen, np.zeros(len(new), dtype=np.int32)])
        self.seen[which.to_numpy()] = self.turn
        found = self.codes.take(which)
        if len(self.units) > self.limit or self.units.nbytes > CACHE_BYTES:
            late = np.argsort(-self.seen, kind="stable")[:self.limit // 2]
            late = late[np.cumsum(pc.binary_length(self.units).to_numpy()[late], dtype=np.int64) <= CACHE_BYTES // 2]
            self.units, self.codes, self.seen = self.units.take(pa.array(late)), self.codes.take(pa.array(late)), self.seen[late]
        return found

    def of(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as little-endian numbers of the width of ``type``."""
        whole = np.full(len(texts), self.cutter is None)
        for special in self.special:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        others = iter(self._whole(texts.filter(pa.array(whole)).to_pylist()) if whole.any() else ())
        if whole.all():
            return [ids.tobytes() for ids in others]
        cuttable = pa.concat_arrays([texts.filter(pa.array(~whole)).cast(pa.binary())])
        offsets = np.frombuffer(cuttable.buffers()[1], np.int32)[:len(cuttable) + 1]
        found = iter(self._of(np.frombuffer(cuttable.buffers()[2] or b"", np.uint8)[:offsets[-1]], offsets))
        return [next(others).tobytes() if w else next(found) for w in whole.tolist()]

    def _of(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        if not len(data):
            return [b""] * (len(offsets) - 1)
        starts = self.cutter.starts(data, np.unique(offsets))
        stops = np.append(starts, len(data)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(stops), pa.py_buffer(data)])
        coded = self._coded(units)
        upto = np.frombuffer(coded.buffers()[1], np.int32)[coded.offset:coded.offset + len(coded) + 1]
        ids = coded.buffers()[2]
        cuts = upto[np.searchsorted(starts, offsets)].tolist()
        return [ids[a:z].to_pybytes() for a, z in zip(cuts[:-1], cuts[1:])]


def _frames(ids: list[int | None], bodies: list[bytes], crc: Crc32c) -> tuple[list[bytes], list[int]]:
    """Framed records and the lengths of what they hold."""
    heads = np.zeros(len(ids), dtype=_HEAD)
    heads["doc_id"] = [i or 0 for i in ids]
    heads["known"] = [i is not None for i in ids]
    records = [heads[k:k + 1].tobytes() + body for k, body in enumerate(bodies)]
    lengths = [len(r).to_bytes(8, "little") for r in records]
    head_sums, sums = crc.masked(lengths).astype("<u4"), crc.masked(records).astype("<u4")
    return [
        n + a.tobytes() + r + z.tobytes() for n, a, r, z in zip(lengths, head_sums, records, sums)
    ], list(map(len, records))


def _writer(path: str, tokenizer: str, end_id: int | None):
    """Write the rows of a task to a file of its own, and give an index row for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, crc = Encoder.shared(tokenizer), Crc32c()
        end = b"" if end_id is None else np.array([end_id], dtype=encoder.type).tobytes()
        filesystem, plain = open_fs(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.records"
        sink, at, before = None, 0, 0
        for block in in_blocks(batches, "text", 4 << 20):
            if sink is None and block.num_rows:
                filesystem.create_dir(plain, recursive=True)
                sink = filesystem.open_output_stream(f"{plain}/{name}")
            bodies = [b + end for b in encoder.of(pc.fill_null(block.column("text"), ""))]
            frames, lengths = _frames(block.column("doc_id").to_pylist(), bodies, crc)
            sink.write(b"".join(frames))
            sizes = np.fromiter(map(len, frames), np.int64, len(frames))
            tokens = np.fromiter((len(b) // encoder.type.itemsize for b in bodies), np.int64, len(bodies))
            yield batch_of({
                "part": np.full(len(frames), part, dtype=np.int32), "file": pa.array([name] * len(frames), pa.string()),
                "doc_id": block.column("doc_id"), "offset": at + np.cumsum(sizes) - sizes, "length": pa.array(lengths, pa.int64()),
                "n_tokens": tokens, "before": before + np.cumsum(tokens) - tokens,
            })
            at, before = at + int(sizes.sum()), before + int(tokens.sum())
        if sink is not None:
            sink.close()

    return write


def write_records(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Encode whole texts, write them in the order of their ids below ``path``, and return the index.

    Each file holds records one after the other: the length in 8 bytes, its masked CRC-32C in 4, the record, and its
    masked CRC-32C in 4, all little-endian. A record is the id (8 bytes, and one that is 0 for a null id), then the
    token ids, in 2 bytes each if the vocabulary fits and else in 4. ``end_id`` is added to each text.

    The index is a Parquet table beside the files: ``part, file, doc_id, offset, length, n_tokens, before`` (tokens
    before the record in its file). Files follow each other in the order of ``part``. Spark commits the index only for
    tasks that ended well, and it alone says which files count: what a lost task has left is removed at the end, and
    would never be read.

    A range sort deals the rows out; rows that are equal in id and text spread by their place in the input. Null ids
    come last, texts with one id in the order of their checksums, repeated rows are written each. Null texts are
    empty; an empty table gives an index without rows. Other columns are not read.
    """
    spark = docs.sparkSession
    order = [
        F.coalesce("doc_id", F.lit((1 << 63) - 1)), F.col("doc_id").isNull(), F.crc32(F.coalesce("text", F.lit(""))),
        F.monotonically_increasing_id(),
    ]
    named = document_columns(docs, doc_id, text).select("*", *(c.alias(f"o{i}") for i, c in enumerate(order)))
    keys = [f"o{i}" for i in range(len(order))]
    ordered = named.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    mapped(ordered, _writer(f"{path}/records", tokenizer, end_id), _INDEX).write.parquet(f"{path}/index")
    index = read_index(spark, path)
    filesystem, plain = open_fs(f"{path}/records")
    named_files = {r.file for r in index.select("file").distinct().toLocalIterator()}  # one for each task that wrote
    for left in filesystem.get_file_info(_selector(plain)):
        if left.base_name not in named_files:
            filesystem.delete_file(left.path)
    return index


def _selector(plain: str):
    from pyarrow import fs

    return fs.FileSelector(plain, allow_not_found=True)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{path}/index")


class BrokenRecord(ValueError):
    """A record that is not what its frame or the index says."""


def _runs(files: list[str], offsets: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows ``[a, z)`` that one read can fetch: of one file, in order, close together."""
    a = 0
    for k in range(1, len(files) + 1):
        if (
            k == len(files) or files[k] != files[a] or not 0 <= offsets[k] - stops[k - 1] <= GAP
            or stops[k] - offsets[a] > READ_BYTES
        ):
            yield a, k
            a = k


def _fetched(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The records that index rows name, in their order, some rows at a time; every checksum is tested."""
    crc = Crc32c()
    filesystem, plain = open_fs(path)
    name, source = None, None
    for batch in batches:
        files = batch.column("file").to_pylist()
        offsets = batch.column("offset").to_numpy()
        lengths = batch.column("length").to_numpy()
        stops = offsets + lengths + _FRAME + 4
        for a, z in _runs(files, offsets, stops):
            if files[a] != name:
                if source is not None:
                    source.close()
                name, source = files[a], filesystem.open_input_file(f"{plain}/{files[a]}")
            start = int(offsets[a])
            data = source.read_at(int(stops[z - 1]) - start, start)
            heads, bodies, told = [], [], []
            for at, n in zip((offsets[a:z] - start).tolist(), lengths[a:z].tolist()):
                stop = at + _FRAME + n
                if len(data) < stop + 4 or int.from_bytes(data[at:at + 8], "little") != n:
                    raise BrokenRecord(f"{name} at {start + at}: not {n} bytes long")
                heads.append(data[at:at + 8])
                bodies.append(data[at + _FRAME:stop])
                told.append(data[at + 8:at + _FRAME] + data[stop:stop + 4])
            sums = np.frombuffer(b"".join(told), "<u4").reshape(-1, 2)
            if (crc.masked(heads) != sums[:, 0]).any() or (crc.masked(bodies) != sums[:, 1]).any():
                raise BrokenRecord(f"{name} from {start} on: a checksum differs")
            yield batch.slice(a, z - a), bodies
    if source is not None:
        source.close()


def _opened(rows: pa.RecordBatch, bodies: list[bytes]) -> dict[str, pa.Array]:
    head = np.frombuffer(b"".join([b[:_HEAD.itemsize] for b in bodies]), _HEAD)
    return {
        "part": rows.column("part"), "doc_id": pa.array(head["doc_id"].astype(np.int64), pa.int64(), mask=head["known"] == 0),
        "before": rows.column("before"),
    }


def _reader(path: str, width: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bodies in _fetched(path, batches):
            ids = np.frombuffer(b"".join([b[_HEAD.itemsize:] for b in bodies]), f"<u{width}").astype(np.int32)
            ends = np.cumsum([len(b) - _HEAD.itemsize for b in bodies]) // width
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids))
            yield batch_of({**_opened(rows, bodies), "ids": lists})

    return read


def _checker(path: str, width: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bodies in _fetched(path, batches):
            ids = [np.frombuffer(b, f"<u{width}", offset=_HEAD.itemsize) for b in bodies]
            yield batch_of({
                **_opened(rows, bodies), "n_tokens": pa.array(list(map(len, ids)), pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
            })

    return check


def _width(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


_ROW = ("part", "file", "offset", "length", "before")


def read_records(index: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """``part, doc_id, before, ids`` of the records that rows of the index name, read from the files in that order.

    Rows that follow each other in a file are fetched by one read of up to 8 MB, others by one read each. Lengths and
    both checksums are tested, and a record that differs ends the job.
    """
    return mapped(index.select(*_ROW), _reader(f"{path}/records", _width(tokenizer)), _RECORD)


def check_records(index: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """``part, doc_id, before, n_tokens, ids_crc32`` of the records, read and tested like those of ``read_records``.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian numbers of four bytes. The ids stay in the task.
    """
    return mapped(index.select(*_ROW), _checker(f"{path}/records", _width(tokenizer)), _CHECKED)


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """The index in a random order that the seed fixes, for ``read_records``: only index rows move."""
    key = F.xxhash64(F.lit(seed), "file", "offset")
    return index.repartitionByRange(key, "file", "offset").sortWithinPartitions(key, "file", "offset")


def starts(index: DataFrame) -> DataFrame:
    """``part, start``: the tokens of all files before each. A row for each file that was written."""
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
