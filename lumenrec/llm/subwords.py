"""Byte-level BPE ids of whole texts, each distinct word encoded once."""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Collection, Iterable
from functools import lru_cache
from itertools import chain

import numpy as np

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file(name: str) -> str:
    """Place of a tokenizer file: a path as it is, else a file of the installed public tokenizers."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``encode`` equals the tokenizer's own result (without special tokens added).

    The tokenizer splits a text before a blank that is followed by a word, and on both sides of a line
    feed between two words, whatever stands around; so where all white space is single blanks and line
    feeds between words, a text's ids are those of its words (each with its blank or line feed) in a
    row. Words are encoded together, once each, and up to ``keep`` of them, and ``room`` bytes, are remembered.
    Any other text, and one with a special token in it, goes to the tokenizer as a whole.
    """

    #: What a remembered word takes besides its letters and ids: two objects and a place in the dictionary.
    ENTRY = 160
    #: Most frequent words of the first texts, in a small dictionary that stays in the CPU's cache.
    HOT = 16_000

    def __init__(self, name: str = TOKENIZER, keep: int = 600_000, room: int = 80 << 20) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one thread
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.opens = np.zeros(self.size, bool)  # tokens that start with a blank or a line feed
        self.opens[[i for t, i in vocabulary.items() if t[0] in "ĠĊ"]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep, self.room = keep, room
        self.known: dict[str, bytes] = {}
        self.held = self.kept = 0  # bytes and number of the known words
        self.hot: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, words: list[str]) -> None:
        """Remember the ids of clean words; a word without a line feed in front has a blank there.

        Words go to the tokenizer some hundred in a text, which it encodes faster than long texts.
        """
        parts = [words[start : start + 500] for start in range(0, len(words), 500)]
        texts = ["".join(w if w[0] == "\n" else " " + w for w in part) for part in parts]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, self.kind)
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(part):  # not the splitting this class relies on
                raise ValueError("this tokenizer does not split before blanks")
            data, cuts = ids.tobytes(), (np.append(cuts, len(ids)) * self.kind.itemsize).tolist()
            self.known.update(zip(part, map(data.__getitem__, map(slice, cuts, cuts[1:]))))

    def clean(self, word: str) -> bool:
        """Whether a word between blanks is one word, but for a line feed in front."""
        bare = word[1:] if word[:1] == "\n" else word
        return bool(bare) and bare.split() == [bare] and not any(s in bare for s in self.special)

    def all_clean(self, words: Collection[str]) -> bool:
        """Whether all words are clean, in one look at all of them (never true if one is not)."""
        bare = [w[1:] if w[:1] == "\n" else w for w in words]
        joined = "".join(bare)
        return all(bare) and joined.split() == [joined] and not any(s in joined for s in self.special)

    def first(self, word: str) -> bytes:
        """Ids of a text's first word, which has no blank in front."""
        found = self.firsts.get(word)
        if found is None:
            if len(self.firsts) >= self.HOT:
                self.firsts.clear()
            found = self.firsts[word] = self.whole(word)
        return found

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``kind``."""
        split = [text.replace("\n", " \n").split(" ") for text in texts]
        out: list = [None] * len(split)
        waiting: list[tuple[int, list[int]]] = []
        fresh: set[str] = set()
        hot, get = self.hot.get, self.known.get
        for k, words in enumerate(split):
            if not self.clean(words[0]) or words[0][0] == "\n":
                out[k] = self.whole(" ".join(words).replace(" \n", "\n"))
                continue
            ids = list(map(hot, words))
            cold = [i for i, found in enumerate(ids) if found is None]
            missing = []
            for i in cold:
                found = get(words[i])
                if found is None:
                    missing.append(i)
                else:
                    ids[i] = found
            ids[0] = b""
            missing = [i for i in missing if i]
            if missing:
                new = {words[i] for i in missing}
                new -= fresh
                if new and not self.all_clean(new) and not all(map(self.clean, new)):
                    out[k] = self.whole(" ".join(words).replace(" \n", "\n"))
                    continue
                fresh |= new
                waiting.append((k, missing))
            ids[0] = self.first(words[0])
            out[k] = ids
        added = list(fresh)
        self.learn(added)
        for k, missing in waiting:
            ids, words = out[k], split[k]
            for i in missing:
                ids[i] = self.known[words[i]]
        if not self.hot and added:
            often = Counter(chain.from_iterable(split[k][1:] for k, ids in enumerate(out) if not isinstance(ids, bytes)))
            self.hot = {w: self.known[w] for w, _ in often.most_common(self.HOT)}
        for w in added:
            size = self.ENTRY + len(w) + len(self.known[w])
            if self.held + size > self.room or self.kept >= self.keep:
                del self.known[w]
            else:
                self.held += size
                self.kept += 1
        return [ids if isinstance(ids, bytes) else b"".join(ids) for ids in out]


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER) -> Encoder:
    """The encoder of this process: Python workers that serve several tasks keep what they have learned."""
    return Encoder(name)
