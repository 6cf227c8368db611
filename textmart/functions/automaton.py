"""Dictionary matching by an automaton over folded bytes, walked over Arrow batches.

The automaton is a trie of all aliases. Between the words of an alias stands a joint,
an arc that reads any run of separators, or none. All places of a batch at which an alias may
begin walk at once: a step of the batch is a few array operations, and walkers that find no arc drop
out, so the work follows how far texts agree with aliases, not how many aliases there are
or how long the longest is.

States are numbered level by level in order of their parents, so the children of a
state are neighbours: two arrays, each state's first child and the byte that leads to
it, hold the trie. It is built once, in one task (its size is checked before), stored in
the shared folder, and read by each worker process once.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from textmart.sources import files

# Executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(files)

# Bytes of text that walk at once; a byte of them takes up to 50 bytes for a while.
SLICE = 1 << 20
JOINT = 1  # no byte of folded text
SEPARATOR = np.zeros(256, bool)
SEPARATOR[list(b" /-")] = True
WORD = np.zeros(256, bool)
WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True


class Trie:
    """`first`: of each state its first child (one more at the end); `byte`: what leads to it;
    `rank`: the order in which its alias is tried, -1 for none; `name`: of each rank its name's place in `names`."""

    def __init__(self, first: np.ndarray, byte: np.ndarray, rank: np.ndarray, name: np.ndarray, names: list[str]) -> None:
        self.first, self.byte, self.rank, self.name, self.names = first, byte, rank, name, names

    def child(self, states: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The state each byte leads to; -1 where there is none. A search among neighbours, few steps for any state."""
        low, high = self.first[states], self.first[states + 1]
        last = len(self.byte) - 1
        while True:
            open_ = low < high
            if not open_.any():
                break
            middle = (low + high) // 2
            less = open_ & (self.byte[np.minimum(middle, last)] < byte)
            low, high = np.where(less, middle + 1, low), np.where(open_ & ~less, middle, high)
        at = np.minimum(low, last)
        return np.where((low < self.first[states + 1]) & (self.byte[at] == byte), at, -1)


def build(aliases: list[tuple[bytes, str]]) -> Trie:
    """The trie of (words with joints between them, canonical name), in the order they are tried."""
    names = sorted({name for _, name in aliases}, key=str.encode)
    place = {name: i for i, name in enumerate(names)}
    data = np.frombuffer(b"".join(a for a, _ in aliases), np.uint8)
    lengths = np.array([len(a) for a, _ in aliases], np.int64)
    starts = np.cumsum(lengths) - lengths
    state, rank = np.zeros(len(aliases), np.int64), np.arange(len(aliases))
    byte, parent, total = [np.zeros(1, np.uint8)], [np.zeros(1, np.int64)], 1
    ranks = [np.full(1, -1, np.int64)]
    depth, on = 0, np.arange(len(aliases))
    while len(on):
        arcs, number = np.unique(state[on] * 256 + data[starts[on] + depth], return_inverse=True)
        state[on] = total + number
        byte.append((arcs % 256).astype(np.uint8))
        parent.append(arcs // 256)
        here = np.full(len(arcs), len(aliases), np.int64)
        depth += 1
        done = on[lengths[on] == depth]
        np.minimum.at(here, state[done] - total, rank[done])
        ranks.append(np.where(here < len(aliases), here, -1))
        total += len(arcs)
        on = on[lengths[on] > depth]
    # Children of lower states come first: a count of parents gives each state's first child.
    first = np.searchsorted(np.concatenate(parent)[1:], np.arange(total + 1)) + 1
    return Trie(first.astype(np.int64), np.concatenate(byte), np.concatenate(ranks), np.array([place[name] for _, name in aliases], np.int64), names)


def stored(trie: Trie, uri: str) -> int:
    """Write the trie as one file; its size."""
    data = io.BytesIO()
    texts = "\0".join(trie.names).encode()
    small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))) if x.min(initial=0) >= 0 else np.int32)
    np.savez(data, first=small(trie.first), byte=trie.byte, rank=small(trie.rank), name=small(trie.name), names=np.frombuffer(texts, np.uint8))
    system, path = files.shared(uri)
    with system.open_output_stream(path, compression=None) as out:
        out.write(data.getvalue())
    return data.tell()


_LOADED: dict[str, Trie] = {}


def loaded(uri: str) -> Trie:
    if uri not in _LOADED:
        system, path = files.shared(uri)
        with system.open_input_stream(path, compression=None) as source:
            arrays = np.load(io.BytesIO(source.read()))
        names = arrays["names"].tobytes().decode().split("\0")
        _LOADED.clear()  # one dictionary at a time in a worker
        _LOADED[uri] = Trie(arrays["first"].astype(np.int64), arrays["byte"], arrays["rank"].astype(np.int64), arrays["name"].astype(np.int64), names)
    return _LOADED[uri]


def found(trie: Trie, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, name) of all matches: leftmost first, of those at one place the alias tried first, none within another."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), ""), pa.array([], pa.large_string())])
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1) if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    if raw is None or offsets[-1] == 0 or len(trie.byte) == 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    data = np.append(np.frombuffer(raw, np.uint8)[: offsets[-1]], 0)
    word = WORD[data]
    may_begin = ~SEPARATOR[data[:-1]]
    may_begin[1:] &= ~word[:-2]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    may_begin[firsts] = ~SEPARATOR[data[firsts]]
    start = np.flatnonzero(may_begin)
    text = np.searchsorted(offsets, start, "right") - 1
    ends = offsets[text + 1]
    other = np.flatnonzero(~SEPARATOR[data])  # where a run of separators ends; the last is beyond all texts

    who, at = np.arange(len(start)), start + 1
    state = trie.child(np.zeros(len(start), np.int64), data[start])
    best, stop = np.full(len(start), np.iinfo(np.int64).max), np.zeros(len(start), np.int64)
    while True:
        alive = state >= 0
        who, at, state = who[alive], at[alive], state[alive]
        if not len(who):
            break
        inside = at < ends[who]
        # An alias ends here, and no word goes on.
        rank = trie.rank[state]
        good = np.flatnonzero((rank >= 0) & ~(inside & word[at]))
        good = good[np.argsort(-rank[good], kind="stable")]
        better = good[rank[good] < best[who[good]]]
        best[who[better]], stop[who[better]] = rank[better], at[better]
        # On through a joint, past separators, and on within the word.
        joint = trie.child(state, np.full(len(state), JOINT, np.uint8))
        past = np.flatnonzero(joint >= 0)
        beyond = other[np.searchsorted(other, at[past])]
        past, beyond = past[beyond < ends[who[past]]], beyond[beyond < ends[who[past]]]
        next_ = np.flatnonzero(inside)
        state = np.concatenate([trie.child(joint[past], data[beyond]), trie.child(state[next_], data[at[next_]])])
        at = np.concatenate([beyond + 1, at[next_] + 1])
        who = np.concatenate([who[past], who[next_]])

    hit = np.flatnonzero(stop)
    taken, free = [], 0
    for i, low, high in zip(hit.tolist(), start[hit].tolist(), stop[hit].tolist()):
        if low >= free:
            taken.append(i)
            free = high
    taken = np.array(taken, np.int64)
    pairs = np.unique(text[taken] * len(trie.names) + trie.name[best[taken]]) if len(taken) else np.zeros(0, np.int64)
    return pairs // max(len(trie.names), 1), pairs % max(len(trie.names), 1)


def slices(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Consecutive texts of so many bytes together, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield texts.slice(at, stop - at)
        at = stop


def lists(trie: Trie, texts: pa.Array) -> pa.Array:
    """Of each text the sorted distinct names of its matches. What a walk takes follows `SLICE`, not the batch."""
    offsets, values, total = [np.zeros(1, np.int64)], [], 0
    for part in slices(texts, SLICE):
        text, name = found(trie, part)
        offsets.append(np.searchsorted(text, np.arange(1, len(part) + 1)) + total)
        values.append(name)
        total += len(name)
    names = np.concatenate(values) if total else np.zeros(0, np.int64)
    found_names = pa.array(trie.names, pa.string()).take(pa.array(names)) if total else pa.array([], pa.string())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), found_names)


def walker(uri: str, folded: str, out: str):
    """A function for `mapInArrow` that puts the lists of column `folded` in its place, named `out`."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = loaded(uri)
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names if name != folded}
            columns[out] = lists(trie, batch.column(folded))
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return walk


def builder(uri: str):
    """A function for `mapInArrow` over (alias, canonical) in one task, in the order they are tried: stores the trie, tells its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aliases = [(alias, name) for b in batches for alias, name in zip(b.column("alias").to_pylist(), b.column("canonical").to_pylist())]
        if aliases:
            yield pa.record_batch([pa.array([stored(build(aliases), uri)], pa.int64())], names=["bytes"])

    return run
