"""SentencePiece merge encoding by backtracking, and decoding.

A text is exactly encoded when every two adjacent tokens are what merging would make of their
joined characters. The encoder walks a word left to right, takes the longest token that an
Aho-Corasick automaton finds at the place and that is compatible with the token before it,
and steps back when none is; a bit per place marks places that proved to lead nowhere, so
none is tried twice. Compatibility is checked by merging the two tokens' characters again.

No token of the vocabulary has a word start inside, nor holds a character that is in no
longer token, so words are encoded apart and kept in a cache of a bounded size per worker.
What a word's ids decode to is checked when it enters the cache.
Unknown characters fall back to byte tokens. Defined results: null is the empty text, which
has no tokens; every row is handled on its own.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

SPACE = "▁"
CACHE_WORDS = 1_000_000
CACHE_PAIRS = 1_000_000
LONG_WORD = 256


class Pieces:
    """Vocabulary of a merge-type model, its encoder and decoder."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = len(model)
        self.text, self.byte_id, self.rank, self.bytes = {}, {}, {}, {}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.bytes[i] = int(piece[1:-1], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = piece
                self.rank[piece] = (-model.get_score(i), i)
        if len(self.byte_id) != 256:
            raise ValueError("the model must fall back to bytes")
        if any(SPACE in p[1:] and set(p) != {SPACE} for p in self.rank):
            raise ValueError("the model has tokens that span words")
        self.raw = [bytes([self.bytes[i]]) if i in self.bytes else self.text.get(i, "").replace(SPACE, " ").encode() for i in range(self.size)]
        self.chars = {p for p in self.rank if len(p) == 1}
        self.found = ahocorasick.Automaton()
        for piece, (_, i) in self.rank.items():
            # A token that merging its own characters does not make is never made.
            if len(piece) < 3 or self.merged(piece) == [piece]:
                self.found.add_word(piece, (len(piece), i))
        self.found.make_automaton()
        joined = {c for p in self.rank if len(p) > 1 for c in p}
        # A character in no longer token never merges, so words may also be cut around it.
        alone = "".join(c for c in "\n\t\r" if c not in joined)
        self.words = re.compile(f"[{re.escape(alone)}]|{SPACE}*[^{SPACE}{re.escape(alone)}]+|{SPACE}+") if alone else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.fits: dict[int, bool] = {}
        self.cache: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """Merge the best-ranked adjacent parts, leftmost first, until none can be."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                got = rank.get(parts[k] + parts[k + 1])
                if got is not None and (best is None or got[0] < best):
                    best, at = got[0], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        key = left * self.size + right
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            a, b = self.text[left], self.text[right]
            fits = self.fits[key] = self.merged(a + b) == [a, b]
        return fits

    def backtrack(self, word: str) -> list[int]:
        """Tokens of a word whose characters are all in the vocabulary."""
        n = len(word)
        # Tokens that start at each place, longest last. A prefix has one encoding at most,
        # so a place is reached with one last token and its options are used up once.
        at: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, found in self.found.iter(word):
            at[end - found[0] + 1].append(found)
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        steps: list[int] = []
        place, base, fits, compatible = 0, -1, self.fits, self.compatible
        while place < n:
            options = at[place]
            while options:
                length, token = options.pop()
                to = place + length
                if failed[to >> 3] >> (to & 7) & 1:
                    continue
                if base < 0 or fits.get(base + token) or base + token not in fits and compatible(out[-1], token):
                    out.append(token)
                    steps.append(length)
                    place, base = to, token * self.size
                    break
            else:
                if not out:
                    raise ValueError(f"no encoding of {word!r}")
                failed[place >> 3] |= 1 << (place & 7)
                out.pop()
                place -= steps.pop()
                base = out[-1] * self.size if out else -1
        return out

    def _known(self, word: str) -> list[int]:
        if self.chars.issuperset(word):
            return self.backtrack(word)
        out, run = [], []
        for c in word:
            if c in self.chars:
                run.append(c)
                continue
            if run:
                out += self.backtrack("".join(run))
                run = []
            out += [self.byte_id[b] for b in c.encode()]
        return out + self.backtrack("".join(run)) if run else out

    def _word(self, word: str) -> str:
        """Ids of a word, written; they decode to the word with spaces for its marks."""
        got = self.cache.get(word)
        if got is None:
            ids = self._known(word)
            if self.spelt(ids) != word.replace(SPACE, " ").encode():
                raise ValueError(f"{word!r} does not decode to itself")
            got = ",".join(map(str, ids))
            if len(word) <= LONG_WORD:
                if len(self.cache) >= CACHE_WORDS:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def _marked(self, text: str) -> list[str]:
        return self.words.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [int(i) for w in self._marked(text) for i in self._word(w).split(",")]

    def spelt(self, ids: list[int]) -> bytes:
        """Bytes of the tokens, word starts as spaces."""
        return b"".join([self.raw[i] for i in ids])

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: the space put before the text goes, bad bytes become U+FFFD."""
        out = self.spelt(ids)
        first = next((i for i in ids if self.raw[i]), None)
        if first in self.text and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, and hashes of the ids and of the decoded text."""
        words = self._marked(text)
        if not words:
            empty = hashlib.sha256(b"").hexdigest()
            return 0, empty, empty
        cache, miss = self.cache.get, self._word
        ids = ",".join([cache(w) or miss(w) for w in words])
        # Each word's ids have been decoded to it, so their texts are the words'.
        spelt = "".join(words)[1:].replace(SPACE, " ")
        return ids.count(",") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(spelt.encode()).hexdigest()


@lru_cache(maxsize=1)
def _loaded(name: str) -> Pieces:
    return Pieces(SparkFiles.get(name))


def _send(df: DataFrame, model_file: str) -> str:
    """Give the vocabulary file to all executors; workers load it once."""
    df.sparkSession.sparkContext.addFile(model_file)
    return os.path.basename(model_file)


def tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids and the text decoded from them."""
    name = _send(docs, model_file)
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = source.schema["doc_id"].dataType.simpleString()

    def encoded(batches):
        model = _loaded(name)
        for batch in batches:
            ids = [model.encode(t) for t in batch.column(1).to_pylist()]
            text = [model.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(text, pa.string())], ["doc_id", "ids", "decoded"]
            )

    return source.mapInArrow(encoded, f"doc_id {key}, ids array<int>, decoded string")


def token_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, number of tokens, hashes of the ids and of the decoded text."""
    name = _send(docs, model_file)
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = source.schema["doc_id"].dataType.simpleString()

    def digests(batches):
        model = _loaded(name)
        for batch in batches:
            for part in range(0, len(batch), 256):
                rows = batch.slice(part, 256)
                found = [model.digest(t.as_py()) for t in rows.column(1)]
                n, ids, text = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(digests, f"doc_id {key}, n_tokens long, ids_sha256 string, decoded_sha256 string")
