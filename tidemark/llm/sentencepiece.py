"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces with log scores.

The best path through a text is the concatenation of the best paths through its chunks, wherever no piece can cross a
boundary: before white space that follows something else, and around bytes that no longer piece holds. So the distinct
chunks of a block of texts are solved once, all in step: the trie is walked from every position of every chunk at once,
and the forward pass advances one position of all chunks at a time. Characters that no piece covers become byte pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import Words, pieces

MARK, SPACE = "▁", b" "
#: Unknown characters score this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Bytes of text whose distinct chunks are solved together; each takes some 250 bytes of memory.
BLOCK = 1 << 19


class DoubleArray:
    """A trie over bytes in two arrays: from state s, byte b leads to base[s] + b if check[that] is s.

    value[s] is the piece that ends in s, or -1.
    """

    def __init__(self, keys: list[tuple[bytes, int]]):
        keys = sorted(keys)
        self.base, self.check, self.value = (np.full(1 << 16, fill, np.int32) for fill in (0, -1, -1))
        self.check[0] = 0
        self._free = self._end = 1
        todo = [(0, 0, len(keys), 0)]
        while todo:
            state, a, b, depth = todo.pop()
            if a < b and len(keys[a][0]) == depth:
                self.value[state] = keys[a][1]
                a += 1
            if a == b:
                continue
            if keys[a][0][depth] == keys[b - 1][0][depth]:  # sorted, so all are the same
                labels, at = np.array([keys[a][0][depth]]), np.zeros(1, np.int64)
            else:
                labels, at = np.unique(np.fromiter((k[0][depth] for k in keys[a:b]), np.int64, b - a), return_index=True)
            self.base[state] = base = self._place(labels)
            self.check[base + labels] = state
            for label, lo, hi in zip(labels.tolist(), (a + at).tolist(), [*(a + at[1:]).tolist(), b], strict=True):
                todo.append((base + label, lo, hi, depth + 1))
        end = int(self.base.max()) + 257
        self._grow(end)
        self.base, self.check, self.value = self.base[:end], self.check[:end], self.value[:end]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base, self.check, self.value = (np.concatenate([x, np.full(more, fill, np.int32)]) for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))

    def _place(self, labels: np.ndarray) -> int:
        """A base at which all labels are free, 1 at least, so that state 0 is nobody's child.

        A lone label takes the first free place; several search from near the end, 256 bases at a time.
        """
        while self.check[self._free] >= 0:
            self._free += 1
            self._grow(self._free + 1024)
        first = int(labels[0])
        if len(labels) == 1 and self._free > first:
            return self._note(self._free - first, first)
        base = max(1, self._free - first, self._end - 2048)
        while True:
            self._grow(base + 1024)
            fits = (self.check[(base + np.arange(256))[:, None] + labels] < 0).all(axis=1)
            if fits.any():
                return self._note(base + int(fits.argmax()), int(labels[-1]))
            base += 256

    def _note(self, base: int, last: int) -> int:
        self._end = max(self._end, base + last)
        return base


@dataclass
class Model:
    """What tasks need of a model: the vocabulary, and the normaliser's flags. It is broadcast, and as large as the vocabulary."""

    surfaces: list[bytes]
    scores: np.ndarray
    kinds: np.ndarray
    dummy_prefix: bool = True

    @classmethod
    def load(cls, path: str) -> Model:
        """From a model file; only those that leave text as it is but for white space are supported."""
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with identity normalisation and white space as prefix are supported")
        return cls.of([(p.piece, p.score, p.type) for p in proto.pieces], spec.add_dummy_prefix)

    @classmethod
    def of(cls, vocabulary: list[tuple[str, float, int]], dummy_prefix: bool = True) -> Model:
        surfaces = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode() for p, _, kind in vocabulary]
        return cls(surfaces, np.array([s for _, s, _ in vocabulary], np.float64), np.array([k for *_, k in vocabulary], np.int8), dummy_prefix)

    @cached_property
    def pieces(self) -> list[tuple[bytes, int]]:
        return [(s, i) for i, (s, k) in enumerate(zip(self.surfaces, self.kinds, strict=True)) if k in (NORMAL, USER) and s]

    @cached_property
    def trie(self) -> DoubleArray:
        return DoubleArray(self.pieces)

    @cached_property
    def depth(self) -> int:
        return max((len(s) for s, _ in self.pieces), default=0)

    @cached_property
    def byte_ids(self) -> np.ndarray:
        out = np.full(256, -1, np.int32)
        for i in np.flatnonzero(self.kinds == BYTE):
            out[self.surfaces[i][0]] = i
        return out

    @cached_property
    def unknown(self) -> int:
        return int(np.flatnonzero(self.kinds == UNKNOWN)[0])

    @cached_property
    def unknown_score(self) -> float:
        return min((self.scores[i] for _, i in self.pieces), default=0.0) - UNKNOWN_PENALTY

    @cached_property
    def crossing(self) -> bool:
        """Whether a piece has white space after anything else; chunks are whole texts then."""
        return any(SPACE in s.lstrip(SPACE) for s, _ in self.pieces)

    @cached_property
    def alone(self) -> np.ndarray:
        """The ASCII bytes that no piece of several bytes holds."""
        held = {b for s, _ in self.pieces if len(s) > 1 for b in s}
        return np.array([b < 128 and b not in held for b in range(256)])

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) for s in self.surfaces], np.int64)
        return np.frombuffer(b"".join(self.surfaces), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def viterbi(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of chunks, one after the other, and how many each has. Of equal scores the piece that starts first wins."""
    n, chunks = len(data), len(offsets) - 1
    sizes = np.diff(offsets)
    chunk = np.repeat(np.arange(chunks), sizes)
    end_of = offsets[1:][chunk]
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    char = np.diff(np.append(starts, n))
    # All pieces that start at a character, by walking the trie from everywhere at once.
    trie, found, has_one = model.trie, [], np.zeros(n, bool)
    size_of = np.zeros(n, np.int64)
    size_of[starts] = char
    state, at = np.zeros(len(starts), np.int64), starts
    for step in range(model.depth):
        go = at + step < end_of[at]
        state, at = state[go], at[go]
        if not len(at):
            break
        new = trie.base[state] + data[at + step]
        go = trie.check[new] == state
        state, at = new[go], at[go]
        value = trie.value[state]
        hit = value >= 0
        found.append((at[hit], np.full(int(hit.sum()), step + 1), value[hit]))
        has_one[at[hit][size_of[at[hit]] == step + 1]] = True
    lone = starts[~has_one[starts]]
    found.append((lone, size_of[lone], np.full(len(lone), -1)))
    begin, length, piece = (np.concatenate(x) for x in zip(*found, strict=True))
    score = np.where(piece >= 0, model.scores[piece], model.unknown_score)
    # Forward: of all chunks, the pieces that start at their k-th byte.
    place = begin - offsets[chunk[begin]]
    order = np.argsort(place, kind="stable")
    begin, length, piece, score, place = begin[order], length[order], piece[order], score[order], place[order]
    node = begin + chunk[begin]  # a chunk has one more node than bytes
    cuts = np.searchsorted(place, np.arange(int(sizes.max(initial=0)) + 1))
    best = np.full(n + chunks, -np.inf)
    best[offsets[:-1] + np.arange(chunks)] = 0
    came, with_ = np.zeros(n + chunks, np.int64), np.full(n + chunks, -1, np.int64)
    for k in range(len(cuts) - 1):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            continue
        to = node[a:b] + length[a:b]
        value = best[node[a:b]] + score[a:b]
        better = value > best[to]
        best[to[better]], came[to[better]], with_[to[better]] = value[better], length[a:b][better], piece[a:b][better]
    # Back from all ends at once.
    at, out_at, out_piece, out_length = offsets[1:] + np.arange(chunks), [], [], []
    first = offsets[:-1] + np.arange(chunks)
    which = np.arange(chunks)
    while True:
        on = at > first[which]
        at, which = at[on], which[on]
        if not len(at):
            break
        at_length = came[at]
        out_piece.append(with_[at])
        at = at - at_length
        out_at.append(at - which)
        out_length.append(at_length)
    if not out_at:
        return np.zeros(0, np.int32), np.zeros(chunks, np.int64)
    at, piece, length = np.concatenate(out_at), np.concatenate(out_piece), np.concatenate(out_length)
    order = np.argsort(at)
    at, piece, length = at[order], piece[order], length[order]
    split = (piece < 0) & bool((model.byte_ids >= 0).all())
    many = np.where(split, length, 1)
    ids = np.repeat(np.where(piece < 0, model.unknown, piece), many)
    spread = np.repeat(split, many)
    if spread.any():
        ids[spread] = model.byte_ids[data[_gather(at[split], length[split])]]
    elif not split.any() and (piece < 0).any():  # unknown characters in a row are one token
        owner = chunk[at]
        keep = np.ones(len(piece), bool)
        keep[1:] = ~((piece[1:] < 0) & (piece[:-1] < 0) & (owner[1:] == owner[:-1]))
        return ids[keep].astype(np.int32), np.bincount(owner[keep], minlength=chunks)
    return ids.astype(np.int32), np.bincount(chunk[at], weights=many, minlength=chunks).astype(np.int64)


def _chunks(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks start."""
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    if not model.crossing and len(data):
        space = data == 0x20
        first[1:] |= space[1:] & ~space[:-1]
        lone = model.alone[data] & ~space
        first |= lone
        first[1:] |= lone[:-1]
    return np.flatnonzero(first)


def normalise(model: Model, column: pa.Array) -> pa.Array:
    """The text as pieces see it, with plain spaces for marks; empty texts stay empty."""
    column = pc.replace_substring(column, MARK, " ")
    if model.dummy_prefix:
        column = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise("", column, " "))
    return column


def encode_column(model: Model, column: pa.Array) -> pa.Array:
    """Lists of ids; null for null."""
    ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for _, _, data, offsets in pieces(normalise(model, column), BLOCK):
        starts = _chunks(model, data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = Words(data, starts, ends, offsets).hashes() if len(starts) else np.zeros(0, np.uint64)
        _, seen, which = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = ends - starts
        rep = seen[which]
        same = np.array_equal(sizes, sizes[rep]) and np.array_equal(data, data[_gather(starts[rep], sizes)])
        if not same:  # two chunks share a hash
            seen, which = np.arange(len(starts)), np.arange(len(starts))
        own = data[_gather(starts[seen], sizes[seen])]
        solved, n = viterbi(model, own, np.concatenate([[0], np.cumsum(sizes[seen])]))
        to = np.concatenate([[0], np.cumsum(n)])
        ids.append(solved[_gather(to[which], n[which])])
        total = np.concatenate([[0], np.cumsum(n[which])])
        counts.append(np.diff(total[np.searchsorted(starts, offsets)]))
    flat, n = np.concatenate(ids), np.concatenate(counts)
    edges = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), mask=np.append(np.asarray(column.is_null()), False)) if column.null_count else pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
    return pa.ListArray.from_arrays(edges, pa.array(flat))


def decode_column(model: Model, column: pa.Array) -> pa.Array:
    """Texts of lists of ids; null for null. Byte pieces that make no valid character become U+FFFD."""
    flat, edges = model.flat
    ids = column.flatten().to_numpy(zero_copy_only=False)
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    sizes = np.diff(edges)[ids]
    raw = flat[_gather(edges[ids], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n)])]
    starts, ends = ends[:-1].copy(), ends[1:]
    if model.dummy_prefix:
        full = np.flatnonzero(starts < ends)
        starts[full[raw[starts[full]] == 0x20]] += 1
    kept = raw[_gather(starts, ends - starts)]
    to = np.concatenate([[0], np.cumsum(ends - starts)])
    made = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(to.astype(np.int64)), pa.py_buffer(kept)])
    try:
        made = made.cast(pa.large_string())
    except pa.ArrowInvalid:
        made = pa.array([x.decode(errors="replace") for x in made.to_pylist()], pa.large_string())
    return pc.if_else(column.is_null(), pa.scalar(None, pa.large_string()), made).cast(pa.string())


def _with(df: DataFrame, column: str, new: dict[str, T.DataType], made: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """df with the columns that made() gives for another one, replacing any of their names; the order of rows stays."""
    taken = {name.lower() for name in new}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), *made(part.column(column))], names=schema.names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """df with the ids of each text, without control tokens, as array<int>; with decoded_col also what decode() makes of them.

    path: the model file, read by the driver. A null text gives null, an empty one no ids. A mark U+2581 in a text is a space
    to the model. Encoding and decoding in one go takes one Python process a task instead of two.
    """
    model = Model.load(path)
    model.trie  # noqa: B018  built once, on the driver
    new: dict[str, T.DataType] = {ids_col: T.ArrayType(T.IntegerType())}
    if decoded_col is None:
        return _with(df, text_col, new, lambda column: [encode_column(model, column)])

    def both(column: pa.Array) -> list[pa.Array]:
        ids = encode_column(model, column)
        return [ids, decode_column(model, ids)]

    return _with(df, text_col, {**new, decoded_col: T.StringType()}, both)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """df with the text of each list of ids; decoding what encode() gave returns the text, but for spaces instead of marks."""
    model = Model.load(path)
    return _with(df, ids_col, {text_col: T.StringType()}, lambda column: [decode_column(model, column.cast(pa.list_(pa.int32())))])
