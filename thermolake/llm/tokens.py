"""Token ids by the tokenizers library, each distinct word encoded once per worker.

A byte-level BPE with a word-splitting pattern never merges across a pre-token. A single space
between two non-space characters starts a new pre-token, so a text is the concatenation of its
first word and of ``" " + word`` for the others. Texts with other runs of white space are encoded
whole.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Words a worker remembers (about 250 bytes each); others are encoded anew each time.
REMEMBERED = 700_000
# Words encoded in one call.
CALL = 4_096

# A word of letters, punctuation, and perhaps a line end with another word: each of them is a
# pre-token. Apostrophes are left out, as they may open a contraction.
LETTERS, SIGNS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[,.!?;:%&*#$|]*"
SIMPLE = re.compile(rf"({LETTERS})({SIGNS}\n?)(?:(?<=\n)({LETTERS})({SIGNS}))?")


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte (fixed by the format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens inside a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        kind = self.tokenizer.pre_tokenizer.__class__.__name__
        self.by_word = kind == "ByteLevel" and self.tokenizer.normalizer is None
        # The same vocabulary for what is one pre-token already, written in byte letters.
        self.single = Tokenizer.from_file(path)
        self.single.encode_special_tokens = True
        self.single.pre_tokenizer = None
        self.single.post_processor = None
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}

    def _call(self, texts: list[str], tokenizer: Tokenizer | None = None) -> list[bytes]:
        tokenizer = tokenizer or self.tokenizer
        out: list[bytes] = []
        for at in range(0, len(texts), CALL):
            encoded = tokenizer.encode_batch_fast(texts[at : at + CALL], add_special_tokens=False)
            ids = [e.ids for e in encoded]
            flat = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            ends = list(accumulate(map(len, ids), initial=0))
            out.extend(flat[4 * a : 4 * b] for a, b in pairwise(ends))
        return out

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Encode words with a leading space; punctuation behind them is encoded apart."""
        matches = list(map(SIMPLE.fullmatch, missing))
        other = [word for word, match in zip(missing, matches) if not match]
        simple = [match for match in matches if match]
        double = [match for match in simple if match[3]]
        tails = {match[2] for match in simple}.union(match[4] for match in double)
        tails = list(tails - self.tails.keys())
        self.tails.update(zip(tails, self._call(tails)))
        text = "\n".join([" " + match[1] for match in simple] + [match[3] for match in double])
        cores = text.encode().decode("latin-1").translate(self.letters).split(self.letters[10])
        ids = self._call(cores if simple else [], self.single)
        out = {match[0]: core + self.tails[match[2]] for match, core in zip(simple, ids)}
        for match, core in zip(double, ids[len(simple) :]):
            out[match[0]] += core + self.tails[match[4]]
        return out | dict(zip(other, self._call([" " + word for word in other])))

    def _heads(self, heads: list[str]) -> list[bytes]:
        """Ids of first words, which no space precedes."""
        missing = list({w for w in heads if w not in self.first})
        fresh = dict(zip(missing, self._call(missing)))
        if len(self.first) < REMEMBERED // 10:
            self.first.update(fresh)
        return [fresh[w] if w in fresh else self.first[w] for w in heads]

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()), "")
        if not self.by_word or not len(texts):
            return [np.frombuffer(b, "<u4") for b in self._call(texts.to_pylist())]
        split = pc.split_pattern(texts, " ")
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        ends = np.append(first[1:], len(split.flatten()))
        flat = split.flatten().dictionary_encode()
        word = flat.indices.to_numpy()
        distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, distinct))
        missing = [i for i, b in enumerate(ids) if b is None]
        # A space next to white space, or at an end, is no sure cut: such texts are encoded whole.
        # A word that is empty or touches white space is never remembered.
        odd = np.zeros(len(distinct), bool)
        odd[[i for i in missing if not distinct[i] or distinct[i] != distinct[i].strip()]] = True
        whole = np.add.reduceat(odd[word].astype(np.int64), first) > 0
        behind = np.ones(len(word), bool)
        behind[first] = False
        used = np.zeros(len(distinct), bool)
        used[word[behind]] = True
        used &= ~odd
        fresh = self._learn([distinct[i] for i in missing if used[i]])
        if len(self.known) < REMEMBERED:
            self.known.update(fresh)
        for i in missing:
            ids[i] = fresh.get(distinct[i], b"") if used[i] else b""
        # Segments: the distinct words, then the heads; words of texts kept whole take the last, empty one.
        heads = self._heads([distinct[i] for i in word[first[~whole]]])
        at_whole = np.flatnonzero(whole)
        texts_whole = self._call(texts.take(pa.array(at_whole)).to_pylist())
        parts = ids + heads + texts_whole + [b""]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        segment = word.astype(np.int64)
        if len(at_whole):
            segment[np.repeat(whole, ends - first)] = len(parts) - 1
        segment[first[~whole]] = len(ids) + np.arange(len(heads))
        segment[first[whole]] = len(ids) + len(heads) + np.arange(len(texts_whole))
        all_ids = np.frombuffer(b"".join(parts), "<u4")
        starts = np.cumsum(sizes) - sizes
        count = sizes[segment]
        at = np.cumsum(count)
        kind = np.int32 if max(at[-1], len(all_ids)) < 1 << 31 else np.int64
        shift = (starts[segment] - (at - count)).astype(kind)
        out = all_ids[np.arange(at[-1], dtype=kind) + np.repeat(shift, count)]
        return np.split(out, at[ends[:-1] - 1])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
