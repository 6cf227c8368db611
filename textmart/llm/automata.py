"""Weighted acyclic automata that map phrases to counts.

An automaton reads a language and then words; its states are numbered level by level in
the order of the paths that lead to them, and an arc adds a label (a word's number in the
automaton's sorted vocabulary) and carries as its weight the count of the phrase read so
far. A weight of 0 marks a path that is only the beginning of longer phrases. All states
without arcs are the one final state and are not stored.

Everything is built level by level from sorted arcs: the arcs of a level are the distinct
(state, label) pairs in order, and their numbers are the next level's states. So the same
step builds an automaton from a shard's sorted n-grams, the union of several (weights of
equal paths summed), and the composition with a set of looked-up phrases.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Automaton(NamedTuple):
    langs: list[str]
    words: pa.Array  # sorted and distinct
    parents: list[np.ndarray]  # of each level: the arc's state (on the first level: its language)
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    @property
    def arcs(self) -> int:
        return sum(map(len, self.labels))


def step(states: np.ndarray, labels: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (state, label) arcs in order, and each input's arc."""
    arcs, number = np.unique(states * size + labels, return_inverse=True)
    return arcs // size, arcs % size, number


def sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in byte order, and each word's place among them."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)


def union(parts: Sequence[Automaton]) -> Automaton:
    """One automaton of all paths, weights of equal paths summed (exact below 2**53)."""
    langs = sorted({lang for p in parts for lang in p.langs})
    words, place = sorted_words(pa.concat_arrays([p.words for p in parts]))
    starts = np.cumsum([0, *[len(p.words) for p in parts]])
    size = max(len(words), 1)
    depth = max(len(p.labels) for p in parts)
    # Where each part's states of the level before lie in the union.
    at = [np.array([langs.index(lang) for lang in p.langs], np.int64) for p in parts]
    out = Automaton(langs, words, [], [], [])
    for d in range(depth):
        here = [i for i, p in enumerate(parts) if d < len(p.labels)]
        states = np.concatenate([at[i][parts[i].parents[d]] for i in here])
        labels = np.concatenate([place[starts[i] + parts[i].labels[d]] for i in here])
        parents, label, number = step(states, labels, size)
        weight = np.bincount(number, np.concatenate([parts[i].weights[d] for i in here]), len(label)).astype(np.int64)
        for part in (out.parents, parents), (out.labels, label), (out.weights, weight):
            part[0].append(part[1])
        ends = np.cumsum([0, *[len(parts[i].labels[d]) for i in here]])
        for k, i in enumerate(here):
            at[i] = number[ends[k] : ends[k + 1]]
    return out


def selected(a: Automaton, keep: list[np.ndarray], own: list[np.ndarray]) -> Automaton:
    """The arcs in `keep` (with each arc its way from the root), weighted where `own`; the vocabulary they need."""
    used = np.unique(np.concatenate([np.zeros(0, np.int64), *[x[k] for x, k in zip(a.labels, keep)]]))
    roots = np.unique(a.parents[0][keep[0]]) if keep else np.zeros(0, np.int64)
    out = Automaton([a.langs[i] for i in roots], a.words.take(pa.array(used)), [], [], [])
    before = roots
    for parent, label, weight, k, o in zip(a.parents, a.labels, a.weights, keep, own):
        out.parents.append(np.searchsorted(before, parent[k]))
        out.labels.append(np.searchsorted(used, label[k]))
        out.weights.append(np.where(o[k], weight[k], 0))
        before = np.flatnonzero(k)
    return out


def pruned(a: Automaton, least: int) -> Automaton:
    """Only the phrases with a weight of at least `least`."""
    own = [w >= least for w in a.weights]
    keep, below = [], None
    for d in reversed(range(len(own))):
        here = own[d].copy()
        if below is not None:
            here[below] = True
        keep.insert(0, here)
        below = a.parents[d][here]
    return selected(a, keep, own)


def ranges(a: Automaton, bounds: Sequence[tuple[str, ...]]) -> list[np.ndarray]:
    """Of each arc of each level the number of bounds (language, words...) at or before its phrase.

    Only paths that a bound goes on from are looked at one by one: below any other path no bound lies.
    """
    words = a.words.to_pylist()
    of = np.array([bisect.bisect_right(bounds, (lang,)) for lang in a.langs], np.int64)
    tied = {}
    for i, lang in enumerate(a.langs):
        low, high = bisect.bisect_left(bounds, (lang,)), bisect.bisect_left(bounds, (lang + "\0",))
        if high > low:
            tied[i] = (low, high)
    out = []
    for d, (parents, labels) in enumerate(zip(a.parents, a.labels)):
        of, next_tied = of[parents], {}
        for state, (low, high) in tied.items():
            first, last = np.searchsorted(parents, [state, state + 1])
            # A bound's word as twice its place, one less if it lies between two words; a bound that ended: first.
            codes = []
            for bound in bounds[low:high]:
                if len(bound) <= d + 1:
                    codes.append(-2)
                else:
                    place = bisect.bisect_left(words, bound[d + 1])
                    codes.append(2 * place - (place == len(words) or words[place] != bound[d + 1]))
            codes = np.array(codes)
            mine = 2 * labels[first:last]
            left, right = np.searchsorted(codes, mine, "left"), np.searchsorted(codes, mine, "right")
            of[first:last] = low + left
            for k in np.flatnonzero(right > left):
                at = low + left[k]
                # The bound that is this very path lies at, not beyond it.
                of[first + k] += len(bounds[at]) == d + 2
                next_tied[first + k] = (at, low + right[k])
        out.append(of)
        tied = next_tied
    return out


def cut(a: Automaton, bounds: Sequence[tuple[str, ...]]) -> Iterator[tuple[int, Automaton]]:
    """The automaton's part for each range between bounds; the way to a part has weight 0."""
    if not a.arcs:
        return
    of = ranges(a, bounds)
    depth = len(of)
    for r in np.unique(np.concatenate(of)).tolist():
        # Levels are in path order: a range's arcs, and the ways to them, are neighbours.
        own = [np.searchsorted(x, [r, r + 1]) for x in of]
        keep = [tuple(o) for o in own]
        for d in reversed(range(depth - 1)):
            low, high = keep[d + 1]
            if high > low:
                ways = a.parents[d + 1][low], a.parents[d + 1][high - 1] + 1
                keep[d] = (min(ways[0], own[d][0]), max(ways[1], own[d][1])) if own[d][1] > own[d][0] else ways
        used = np.unique(np.concatenate([x[low:high] for x, (low, high) in zip(a.labels, keep)]))
        roots, root = np.unique(a.parents[0][slice(*keep[0])], return_inverse=True)
        part = Automaton([a.langs[i] for i in roots], a.words.take(pa.array(used)), [], [], [])
        for d, (low, high) in enumerate(keep):
            weight = a.weights[d][low:high].copy()
            weight[: max(own[d][0] - low, 0)] = 0
            part.parents.append(a.parents[d][low:high] - keep[d - 1][0] if d else root)
            part.labels.append(np.searchsorted(used, a.labels[d][low:high]))
            part.weights.append(weight)
        yield r, part


def weights_of(a: Automaton, phrases: Sequence[tuple[str, ...]]) -> np.ndarray:
    """The weight of each (language, words...): the phrases' own automaton, composed with this one.

    Both are walked together level by level; a state of the phrases stands at one state here, or at none (-1).
    """
    size = max(len(a.words), 1)
    out, depth = np.zeros(len(phrases), np.int64), np.array([len(p) - 1 for p in phrases], np.int64)
    roots = {lang: i for i, lang in enumerate(a.langs)}
    met = np.array([roots.get(p[0], -1) for p in phrases], np.int64)
    state = np.unique(met, return_inverse=True)[1].astype(np.int64)
    for d in range(min(int(depth.max(initial=0)), len(a.labels))):
        more = np.flatnonzero((depth > d) & (met >= 0))
        label = pc.index_in(pa.array([phrases[i][d + 1] for i in more], a.words.type), a.words)
        label = pc.fill_null(label, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = label >= 0
        more, label = more[known], label[known]
        # The phrases' arcs, each looked up once.
        _, arc_label, number = step(state[more], label, size)
        arc_met = np.zeros(len(arc_label), np.int64)
        arc_met[number] = met[more]
        keys = a.parents[d] * size + a.labels[d]
        wanted = arc_met * size + arc_label
        place = np.searchsorted(keys, wanted)
        place = np.where(keys[np.minimum(place, len(keys) - 1)] == wanted, place, -1) if len(keys) else np.full(len(wanted), -1)
        beyond = np.full(len(phrases), -1, np.int64)
        beyond[more], state[more] = place[number], number
        met = np.where(depth > d, beyond, -1)
        ends = np.flatnonzero((depth == d + 1) & (met >= 0))
        out[ends] = a.weights[d][met[ends]]
    return out


def phrases_of(a: Automaton, shortest: int = 1) -> Iterator[tuple[str, list[str], int]]:
    """(language, words, weight) of each weighted phrase of at least `shortest` words."""
    words = a.words.to_pylist()
    ways = [(lang, []) for lang in a.langs]
    for d, (parents, labels, weights) in enumerate(zip(a.parents, a.labels, a.weights)):
        ways = [(ways[p][0], [*ways[p][1], words[x]]) for p, x in zip(parents.tolist(), labels.tolist())]
        if d + 1 >= shortest:
            yield from ((lang, way, w) for (lang, way), w in zip(ways, weights.tolist()) if w)


def dumps(a: Automaton) -> bytes:
    """Compressed bytes: words' lengths and bytes, then of each level the steps of the states, labels and weights."""
    offsets = np.frombuffer(a.words.buffers()[1], np.int64, len(a.words) + 1, a.words.offset * 8) if len(a.words) else np.zeros(2, np.int64)
    text = a.words.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if offsets[-1] > offsets[0] else b""
    arrays = [pc.binary_length(a.words).to_numpy()]
    for parents, labels, weights in zip(a.parents, a.labels, a.weights):
        arrays += [np.diff(parents, prepend=0), labels, weights]
    small = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in arrays]
    head = json.dumps([a.langs, len(text), [(x.dtype.str, len(x)) for x in small]]).encode()
    body = b"".join([len(head).to_bytes(4, "little"), head, text, *[x.tobytes() for x in small]])
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def loads(data: bytes) -> Automaton:
    body = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    start = 4 + int.from_bytes(body[:4], "little")
    langs, size, kinds = json.loads(body[4:start])
    text, at = body[start : start + size], start + size
    arrays = []
    for kind, n in kinds:
        arrays.append(np.frombuffer(body, kind, n, at).astype(np.int64))
        at += arrays[-1].size * np.dtype(kind).itemsize
    offsets = np.concatenate([[0], np.cumsum(arrays[0])]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(arrays[0]), pa.py_buffer(offsets), pa.py_buffer(text))
    return Automaton(langs, words, [np.cumsum(x) for x in arrays[1::3]], arrays[2::3], arrays[3::3])
