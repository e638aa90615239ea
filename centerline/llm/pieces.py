"""Sampled segmentations of texts into SentencePiece pieces, and the way back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import Vocabulary, in_blocks, mix

U = np.uint64
# No piece holds a line feed or a space behind another character, so the lattice of a text falls into these parts.
_PART = re.compile(r" *[^ \n]+|\n| +")
_BITS = 20


class Pieces:
    """The pieces of a model: their log-probabilities, a trie over them, and their bytes.

    Byte-pair models carry minus the rank of a merge as score. With ``ranked`` a piece of rank ``r`` has probability
    in proportion to ``1 / (r + 1)``; otherwise scores are taken as log-probabilities, as in unigram models.
    A space stands for the mark that pieces use for it.
    """

    def __init__(self, path: str, ranked: bool = True):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.bytes: list[bytes] = [b""] * size
        self.byte_ids = np.zeros(256, dtype=np.int32)
        normal = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.bytes[i] = bytes([value])
                self.byte_ids[value] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = piece.replace("▁", " ")
                if "\n" in text or " " in text.lstrip(" "):
                    raise ValueError(f"piece {piece!r} crosses the parts that texts are cut into")
                self.bytes[i] = text.encode()
                normal.append((i, text))
        scores = np.array([model.get_score(i) for i in range(size)])
        logs = -np.log1p(np.maximum(-scores, 0)) if ranked else scores
        ids = np.array([i for i, _ in normal])
        self.logs = logs - np.log(np.exp(logs[ids]).sum())
        self.fallback = float(self.logs[ids].min()) - 10.0
        self._trie(normal)

    def _trie(self, pieces: list[tuple[int, str]]) -> None:
        """Nodes are numbers, edges sit in an open hash table under ``node << 21 | code point``."""
        edges: dict[int, int] = {}
        ends = {}
        for i, text in pieces:
            node = 0
            for c in text:
                node = edges.setdefault(node << 21 | ord(c), len(edges) + 1)
            ends[node] = i
        bits = max(_BITS, (2 * len(edges)).bit_length())
        self.shift = U(64 - bits)
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.next = np.full(1 << bits, -1, dtype=np.int32)
        slots = (mix(np.fromiter(edges, np.int64, len(edges))) >> self.shift).astype(np.int64).tolist()
        for (key, node), slot in zip(edges.items(), slots):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.next[slot] = key, node
        self.end = np.full(len(edges) + 1, -1, dtype=np.int32)
        self.end[list(ends)] = list(ends.values())

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The trie node behind each node and character, -1 where there is none."""
        key = node.astype(np.int64) << 21 | char
        slot = (mix(key) >> self.shift).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == key, self.next[slot], -1)
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.next[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The text of a segmentation, without the space put before it."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]


class Lattice:
    """All segmentations of some parts at once, filtered forward.

    Every part has a node before, between and behind its characters, an edge for each piece that fits, and one for
    each character that is no piece, which stands for its bytes. ``first`` and ``share`` give for each node the edges
    that end there and, summed up, their chances given that a segmentation passes the node.
    """

    def __init__(self, parts: list[str], pieces: Pieces, alpha: float):
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes)
        part = np.repeat(np.arange(len(parts)), sizes)
        left = ends[part] - np.arange(len(chars))  # characters up to the end of the part
        self.chars = chars
        self.begin = ends - sizes + np.arange(len(parts))
        self.finish = self.begin + sizes
        # Pieces that start at each character, by length.
        at, node, lengths, sources, ids = np.arange(len(chars)), np.zeros(len(chars), np.int32), [], [], []
        length, single = 0, np.zeros(len(chars), dtype=bool)
        while len(at):
            node = pieces.step(node, chars[at + length])
            alive = node >= 0
            at, node = at[alive], node[alive]
            length += 1
            piece = pieces.end[node]
            is_piece = piece >= 0
            if length == 1:
                single[at[is_piece]] = True
            sources.append(at[is_piece])
            ids.append(piece[is_piece])
            lengths.append(np.full(int(is_piece.sum()), length))
            more = left[at] > length
            at, node = at[more], node[more]
        bare = np.flatnonzero(~single)
        source = np.concatenate([*sources, bare])
        piece = np.concatenate([*ids, -1 - bare])
        length = np.concatenate([*lengths, np.ones(len(bare), dtype=np.int64)])
        weight = alpha * np.where(piece >= 0, pieces.logs[np.maximum(piece, 0)], pieces.fallback)
        source = source + part[source]
        target = source + length
        by = np.argsort(target, kind="stable")
        source, target, piece, weight = source[by], target[by], piece[by], weight[by]
        # Forward: all parts together, one character further at a time.
        depth = target - np.repeat(self.begin, sizes + 1)[target]
        rounds = np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 65536 else depth, kind="stable")
        n_nodes = len(chars) + len(parts)
        forward = np.zeros(n_nodes)
        chance = np.empty(len(target))
        bounds = np.concatenate(([0], np.cumsum(np.bincount(depth)[1:]))) if len(depth) else np.zeros(1, np.int64)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            edge = rounds[a:b]
            to = target[edge]
            head = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            group = np.cumsum(np.concatenate(([0], to[1:] != to[:-1])))
            value = forward[source[edge]] + weight[edge]
            top = np.maximum.reduceat(value, head)
            total = top + np.log(np.add.reduceat(np.exp(value - top[group]), head))
            forward[to[head]] = total
            chance[edge] = np.exp(value - total[group])
        head = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate((head, [len(target)])))
        upto = np.cumsum(chance)
        self.share = upto - np.repeat(upto[head] - chance[head], count)
        self.share[head + count - 1] = 2.0  # the last one takes the rest
        self.first = np.zeros(n_nodes, dtype=np.int64)
        self.first[target[head]] = head
        self.source, self.piece, self.log_total = source, piece, forward[self.finish]

    def sample(self, parts: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A segmentation of each of ``parts``, drawn backward: its edges in order, and how many there are."""
        live, node = np.arange(len(parts)), self.finish[parts]
        begin = self.begin[parts]
        count = np.zeros(len(parts), dtype=np.int64)
        steps = []
        turn = 0
        while len(live):
            draw = (mix(seeds[live] + U(turn)) >> U(11)).astype(np.float64) * 2.0**-53
            edge = self.first[node]
            open_ = np.flatnonzero(draw >= self.share[edge])
            while len(open_):
                edge[open_] += 1
                open_ = open_[draw[open_] >= self.share[edge[open_]]]
            steps.append((live, edge))
            count[live] += 1
            node = self.source[edge]
            more = node > begin[live]
            live, node = live[more], node[more]
            turn += 1
        behind = np.cumsum(count)
        out = np.empty(int(behind[-1]) if len(behind) else 0, dtype=np.int64)
        for turn, (own, edge) in enumerate(steps):
            out[behind[own] - 1 - turn] = edge
        return out, count


def segment(texts: list[str | None], keys: np.ndarray, pieces: Pieces, alpha: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one behind the other, and how many each text has.

    A space is put before a text that is not empty. What is drawn depends on ``seed``, the text's key, and the place
    of a part in the text, and on nothing else.
    """
    numbers = Vocabulary()
    found = [_PART.findall(" " + t) if t else [] for t in texts]
    which = numbers.numbers([p for own in found for p in own])
    per_text = np.fromiter(map(len, found), np.int64, len(found))
    if not len(which):
        return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
    lattice = Lattice(list(numbers), pieces, alpha)
    text = np.repeat(np.arange(len(texts)), per_text)
    place = np.arange(len(which)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    own = mix(keys.astype(np.int64).view(np.uint64) + mix(np.array([seed], dtype=np.uint64)))
    seeds = mix(own[text] + place.astype(np.uint64))
    edges, count = lattice.sample(which, seeds)
    ids = lattice.piece[edges]
    bare = np.flatnonzero(ids < 0)
    sizes = np.ones(len(ids), dtype=np.int64)
    if len(bare):
        # Characters that are no pieces: their bytes, each a piece.
        codes, code = np.unique(lattice.chars[-1 - ids[bare]], return_inverse=True)
        spelled = [chr(c).encode() for c in codes.tolist()]
        sizes[bare] = np.array([len(b) for b in spelled])[code]
        out = np.repeat(ids, sizes)
        start = np.cumsum(sizes) - sizes
        for k in range(max(map(len, spelled))):
            long = sizes[bare] > k
            letters = np.array([b[k] if len(b) > k else 0 for b in spelled])
            out[start[bare[long]] + k] = pieces.byte_ids[letters[code[long]]]
        ids = out
    upto = np.cumsum(sizes)[np.cumsum(count) - 1]
    edge_text = np.bincount(text, weights=np.diff(np.concatenate(([0], upto))), minlength=len(texts))
    return ids.astype(np.int32), edge_text.astype(np.int64)


_SAMPLED = "struct<ids:array<int>,n_pieces:long,lossless:boolean>"


def sampled(text: Column, key: Column, path: str, alpha: float = 0.5, seed: int = 0, ranked: bool = True) -> Column:
    """A column ``struct(ids, n_pieces, lossless)``: a segmentation of the text, drawn with chances in proportion to
    ``exp(alpha * log-probability)`` of its pieces, over all segmentations there are.

    Same text, key and ``seed``: same ids, wherever and however often a row is computed. ``lossless`` says that
    decoding the ids gives the text back, which is tested for each row. Characters that are no pieces become their
    bytes. A null or empty text has no ids; a null key is a key like any other.
    """

    @F.arrow_udf(_SAMPLED)
    def draw(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pieces = Pieces(path, ranked)
        for texts, keys in batches:
            whole = pa.RecordBatch.from_arrays([texts, keys], ["text", "key"])
            out = [drawn(b, pieces, alpha, seed) for b in in_blocks([whole], "text", 1 << 20)]
            yield pa.concat_arrays(out) if out else pa.array([], _sampled_type())

    return draw(text.cast("string"), F.coalesce(F.xxhash64(key), F.lit(0)))


def _sampled_type() -> pa.DataType:
    return pa.struct([("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("lossless", pa.bool_())])


def drawn(batch: pa.RecordBatch, pieces: Pieces, alpha: float, seed: int) -> pa.Array:
    texts = batch.column("text").to_pylist()
    ids, count = segment(texts, batch.column("key").to_numpy(zero_copy_only=False), pieces, alpha, seed)
    offsets = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
    numbers = ids.tolist()
    same = [
        (pieces.decode(numbers[a:b]) == t.encode()) if t else a == b
        for t, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist())
    ]
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(count), pa.array(same, pa.bool_())],
        ["ids", "n_pieces", "lossless"],
    )


def decoded(ids: Column, path: str) -> Column:
    """The text of ids; null for null. Bytes that are no UTF-8 become replacement characters."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(path)
        for batch in batches:
            yield pa.array(
                [None if own is None else pieces.decode(own).decode("utf-8", "replace") for own in batch.to_pylist()],
                pa.string(),
            )

    return decode(ids)


def with_pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", alpha: float = 0.5, seed: int = 0,
) -> DataFrame:
    """One row per document: ``doc_id, ids, n_pieces, lossless`` (see ``sampled``), seeded by the id."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), sampled(F.col(text), F.col(doc_id), path, alpha, seed).alias("s"))
    return rows.select("doc_id", "s.ids", "s.n_pieces", "s.lossless")
