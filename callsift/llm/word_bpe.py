"""Token ids of a word-level BPE vocabulary, with whole words cached and batched.

The vocabulary file is one of the public tokenizers' JSON files. Its pre-tokenizer
never crosses white space, so a text's ids are those of its white-space chunks in
order. Chunks are cached per worker. A chunk of plain Latin characters that is not
cached is split and merged here, thousands of words at a time in numpy; any other
chunk, and one that may hold a special token (the library finds those in texts, too),
goes to the ``tokenizers`` library. Both give the library's ids.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: White-space chunks kept per worker before the cache starts anew.
CACHE_CHUNKS = 600_000
#: Words, digits and punctuation kept per worker before that cache starts anew.
CACHE_PIECES = 500_000
#: Characters for which str.lower() and the split below match the library's normaliser and pattern.
PLAIN = re.compile(r"[!-~À-ÖØ-Þß-öø-ÿ]+")
#: str.split() takes these for white space, the vocabulary's pattern does not.
ODD = re.compile(r"[\x1c-\x1f]")
SPACES = re.compile(r"[^\S\x1c-\x1f]+")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class WordBpe:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 16-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        #: Beginning that all special tokens share; a chunk without it holds none.
        self.special = os.path.commonprefix([t.content for t in self.library.get_added_tokens_decoder().values()])
        if len(vocab) >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.uint32)
        self.final = np.array([vocab[c + end] for c in chars], np.uint32)
        merges = model["merges"]
        pairs = np.array([vocab[a] << 16 | vocab[b] for a, b in merges], np.uint32)
        made = np.array([vocab[a + b] for a, b in merges], np.uint32)
        order = np.argsort(pairs)
        self.pairs, self.made, self.rank = pairs[order], made[order], order.astype(np.int32)
        self.cache: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of non-empty words, merged in rank order, leftmost first, all words at once."""
        none = np.int32(2**31 - 1)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.final[flat[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_sym, done_word = [], []
        while len(sym):
            key = sym[:-1] << 16 | sym[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.full(len(sym), none)
            rank[:-1] = np.where((self.pairs[at] == key) & (word[:-1] == word[1:]), self.rank[at], none)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(sym)])))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = best == none
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
            hit = np.flatnonzero((rank == best) & ~over)
            if len(hit):
                # Of overlapping hits (aaa) every second one merges, from the left.
                run = np.flatnonzero(np.concatenate(([True], np.diff(hit) != 1)))
                place = np.arange(len(hit)) - np.repeat(run, np.diff(np.concatenate((run, [len(hit)]))))
                hit = hit[place % 2 == 0]
                sym = sym.copy()
                sym[hit] = self.made[at[hit]]
                keep = ~over
                keep[hit + 1] = False
            else:
                keep = ~over
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        data = sym[order].astype("<u2").tobytes()
        cuts = np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words))))) * 2
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def _learn(self, chunks: list[str]) -> None:
        split, plain, odd = [], [], []
        for c in chunks:
            if c.isascii() and c.isalpha():
                ws = (c.lower(),)
            elif c.isascii() and c[:-1].isalpha() and c[-1] in ".,":
                ws = (c[:-1].lower(), c[-1])
            elif self.special not in c and PLAIN.fullmatch(c):
                ws = PIECES.findall(c.lower())
            else:
                odd.append(c)
                continue
            plain.append(c)
            split.append(ws)
        known = self.pieces
        if len(known) > CACHE_PIECES:
            known.clear()
        fresh = list({w for ws in split for w in ws if w not in known})
        if fresh:
            known.update(zip(fresh, self.merge_words([w.encode() for w in fresh])))
        self.cache.update(zip(plain, [known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for ws in split]))
        if odd:
            for c, e in zip(odd, self.library.encode_batch(odd, add_special_tokens=False)):
                self.cache[c] = np.array(e.ids, "<u2").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [SPACES.split(t) if ODD.search(t) else t.split() for t in texts]
        known = self.cache
        if len(known) > CACHE_CHUNKS:
            known.clear()
        known.setdefault("", b"")
        missing = list({w for ws in split for w in ws if w not in known})
        if missing:
            self._learn(missing)
        return [b"".join(map(known.__getitem__, ws)) for ws in split]


_HELD: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The worker's encoder for a vocabulary file, loaded once."""
    if path not in _HELD:
        _HELD[path] = WordBpe(path)
    return _HELD[path]
