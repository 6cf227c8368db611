"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of
every pair of neighbours by binary search over the sorted pair keys
(left id * size + right id), takes the lowest rank of each word and merges it
there, from the left. Words without a pair left over leave the array.

Reads tokenizer files of the public `tokenizers` JSON form that hold a BPE model
with an end-of-word suffix, the byte-level alphabet, NFC + lower case, and a
pattern whose matches are the words. `Bpe.load` refuses any other file.

Defined cases: a null or empty text has no ids and decodes to "". Special strings
inside a text become their ids. White space is dropped. Repeated rows are encoded
each. Columns beside the text are kept as they are.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textmart.llm.common import arrow_texts, by_value, slices

NO_RANK = np.iinfo(np.int64).max
# Words whose ids a task remembers.
CACHE_WORDS = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PreTokens:
    """Words of a text as the tokenizer file splits it, with special strings cut out."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        self.source = source
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Latin text that neither NFC nor lower-casing moves out of the range: the words by `re`.
        plain = [c for c in map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0x180)]) if c != "İ"]
        low = sorted({x for c in plain for x in c.lower()})
        kinds = {k: re.escape("".join(c for c in low if unicodedata.category(c)[0] == k)) for k in "LN"}
        white = re.escape("\t\n\r ")
        self.plain = re.compile("[" + re.escape("".join(plain)) + "]*")
        self.words = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{white}{kinds['L']}{kinds['N']}]+").findall
        self._library = None
        self._bytes = {c: b for b, c in enumerate(byte_alphabet())}

    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
        return self._library

    def segment(self, text: str) -> list[str]:
        if self.plain.fullmatch(text):
            return self.words(text.lower())
        # Other scripts: the library's own character tables.
        t = self.library()
        coded = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return [bytes(map(self._bytes.__getitem__, w)).decode() for w, _ in coded]

    def __call__(self, text: str) -> list[str | int]:
        """Words; an int is the id of a special string."""
        if self.cut is None or "<|" not in text and not self.cut.search(text):
            return self.segment(text)
        out: list[str | int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self.segment(part)
        return out


class Bpe:
    """Tables of one tokenizer file, and the merge rounds over them."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        model = spec["model"]
        kinds = [p["type"] for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or model["dropout"] or model["ignore_merges"] or kinds != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError("not a word BPE file of the supported form")
        vocab = dict(model["vocab"])
        self.suffix = model["end_of_word_suffix"]
        names = vocab | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(names.values()) + 1
        self.tokens = np.full(self.size, b"", object)
        for token, i in names.items():
            self.tokens[i] = token.encode()
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in alphabet], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        # Of a repeated pair the last rank counts, as in a map filled in order.
        last = np.append(np.diff(keys[order]) != 0, True) if len(keys) else np.zeros(0, bool)
        self.keys, self.ranks = keys[order][last], order[last].astype(np.int64)
        self.made = made
        # All places of a pair may be merged at once if no pair with its product has a lower rank.
        lowest = np.full(self.size, NO_RANK)
        np.minimum.at(lowest, left, np.arange(len(left)))
        np.minimum.at(lowest, right, np.arange(len(left)))
        self.at_once = lowest[made] > np.arange(len(made)) if len(made) else np.zeros(0, bool)
        self.pre_tokens = PreTokens(source)
        self._seen: dict[str | int, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Bpe:
        return cls(Path(path).read_text(encoding="utf-8"))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words in one flat array, and each word's first place (one more than words)."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[raw]
        ends = np.cumsum(sizes)
        ids[ends - 1] = self.final[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        rank = np.full(len(ids), NO_RANK)
        inside = word[:-1] == word[1:]
        rank[:-1][inside] = self.pair_ranks(ids[:-1][inside], ids[1:][inside])
        while len(ids):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.append(starts, len(ids)))
            live = best != NO_RANK
            if not live.all():
                keep = np.repeat(live, spans)
                done_ids.append(ids[~keep])
                done_words.append(word[~keep])
                ids, word, rank, best, spans = ids[keep], word[keep], rank[keep], best[live], spans[live]
                if not len(ids):
                    break
            each = np.repeat(best, spans)
            hit = np.flatnonzero(rank == each)
            # Only the leftmost place of a word where merging all at once could differ.
            single = ~self.at_once[each[hit]]
            if single.any():
                first = np.append(True, word[hit[1:]] != word[hit[:-1]])
                hit = hit[first | ~single]
            # Of overlapping places (a a a) every second one counts, from the left.
            if len(hit) > 1:
                run = np.append(True, (np.diff(hit) != 1))
                begin = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            ids[hit] = self.made[each[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[hit]
            ids, word, rank = ids[keep], word[keep], rank[keep]
            # Ranks change only beside what was merged.
            touched = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[touched] = NO_RANK
            touched = touched[touched < len(ids) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self.pair_ranks(ids[touched], ids[touched + 1])
        ids, word = np.concatenate(done_ids or [ids]), np.concatenate(done_words or [word])
        order = np.argsort(word, kind="stable")
        counts = np.bincount(word, minlength=len(words))
        return ids[order], np.concatenate([[0], np.cumsum(counts)])

    def learn(self, words: list[str | int]) -> dict[str | int, bytes]:
        """Ids (little-endian unsigned 32-bit) of every word, from rounds over those not seen before."""
        if len(self._seen) > CACHE_WORDS:
            self._seen = {}
        new = [w for w in set(words) if w not in self._seen]
        texts = [w for w in new if isinstance(w, str)]
        self._seen.update((w, np.uint32(w).tobytes()) for w in new if not isinstance(w, str))
        if texts:
            ids, at = self.merge([w.encode() for w in texts])
            flat, at = ids.astype("<u4").tobytes(), (at * 4).tolist()
            self._seen.update((w, flat[a:b]) for w, a, b in zip(texts, at, at[1:]))
        return self._seen

    def counts(self, words: list[str]) -> np.ndarray:
        """Number of pieces of each non-empty word."""
        return np.diff(self.merge([w.encode() for w in words])[1]) if words else np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pre_tokens(t) for t in texts]
        known = self.learn([w for ws in split for w in ws])
        return [b"".join(map(known.__getitem__, ws)) for ws in split]

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' strings with a blank between, in UTF-8; a file without a decoder asks for no more."""
        return b" ".join(self.tokens[ids].tolist())


def encode_decode(
    docs: DataFrame, tokenizer: str, text: str = "text", *, ids: str | None = None, decoded: str | None = None,
    n_tokens: str = "n_tokens", ids_sha256: str = "ids_sha256", decoded_sha256: str = "decoded_sha256",
) -> DataFrame:
    """The rows with the text's ids and what they decode to, or digests of both.

    `tokenizer` is the path of the tokenizer file; the driver reads it and ships its
    content. `ids` and `decoded` name columns for the ids (array of long) and the
    decoded text; without them only count and digests are added. A column with a
    name that is added is replaced. One pass without a shuffle; a task holds a few
    MB of text, its ids, and at most CACHE_WORDS remembered words.
    """
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))  # one file, a few MB
    added = [T.StructField(n_tokens, T.LongType()), T.StructField(ids_sha256, T.StringType()), T.StructField(decoded_sha256, T.StringType())]
    if ids:
        added.append(T.StructField(ids, T.ArrayType(T.LongType())))
    if decoded:
        added.append(T.StructField(decoded, T.StringType()))
    names = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType(kept + added)
    columns = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(source.value)
        for batch in slices(batches, text):
            coded = bpe.encode(arrow_texts(batch.column(text)).to_pylist())
            arrays = [np.frombuffer(c, "<u4") for c in coded]
            plain = [bpe.decode(a) for a in arrays]
            out = [batch.column(c) for c in columns]
            out += [pa.array([len(a) for a in arrays], pa.int64())]
            out += [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (coded, plain)]
            if ids:
                out.append(pa.array([a.astype(np.int64) for a in arrays], pa.list_(pa.int64())))
            if decoded:
                out.append(pa.array([p.decode("utf-8", "replace") for p in plain], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=[f.name for f in schema])

    return docs.mapInArrow(by_value(run), schema)
