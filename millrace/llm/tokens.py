"""Token ids of whole texts, with a bounded cache of words in each Python worker.

A word-level BPE file (lower case, white space dropped, word ends marked) encodes every
white-space-separated word on its own, so the ids of a text are those of its words in order. Each
batch of texts is cut into words; those not yet in the cache are merged together in one call over
the ranks of the same file. Words with letters beyond Latin script, and any tokenizer of another
kind, go through the tokenizer itself. The two ways agree because each entry of the vocabulary
encodes to itself (tests/llm checks all of them).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from tokenizers import Tokenizer

CACHE_WORDS = 250_000  # in each of two generations
SLICE_CHARS = 4_000_000
END = "\x01"  # stands for the end-of-word mark; texts that hold it take the tokenizer itself
#: Fixed value: the split pattern of the word-level vocabulary.
WORD_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SCRIPT = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250))]
_LETTERS = "".join(c for c in _SCRIPT if c.isalpha())
_NUMBERS = "".join(c for c in _SCRIPT if c.isnumeric() and not c.isalpha())
_PIECES = regex.compile(WORD_PIECES)
#: ASCII but for other control characters, and the bytes of U+0080 to U+024F.
_USUAL = bytes([*range(9, 14), *range(32, 127), *range(0x80, 0xC0), *range(0xC2, 0xCA)])
_OTHER = regex.compile("[^\t\n\v\f\r -~¡-ɏ]|<\\|")
_OPEN: dict[str, TokenIds] = {}


def _byte_chars() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the rest follow from code point 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def _is_latin(text: str) -> bool:
    raw = text.encode()
    if raw.translate(None, _USUAL) or "İ" in text:  # the one letter here that lowers to two
        return False
    return not _OTHER.search(text) if b"\xc2" in raw or b"\xc9" in raw or b"<|" in raw else True


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


class TokenIds:
    """Ids without special tokens, packed as little-endian unsigned numbers of `dtype`."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = suffix == "</w>" and bool(steps) and steps[0].get("pattern", {}).get("Regex") == WORD_PIECES
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        if self.by_word:
            raw, ranks = _byte_chars(), {}
            added = {x["id"] for x in spec["added_tokens"]}
            for token, i in spec["model"]["vocab"].items():
                if i not in added:
                    body, end = (token[:-4], END.encode()) if token.endswith("</w>") else (token, b"")
                    ranks[bytes(raw[c] for c in body) + end] = i
            self.merges = tiktoken.Encoding("words", pat_str=f"[^{END}]*{END}", mergeable_ranks=ranks, special_tokens={})
            self.ends = np.zeros(max(ranks.values()) + 1, bool)
            self.ends[[i for token, i in ranks.items() if token.endswith(END.encode()) and len(token) > 1]] = True

    def slow(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, words: list[str]) -> None:
        plain, marked = [], []
        for word in words:
            if not _is_latin(word):
                self.cache[word] = self._pack(self.slow(word))
                continue
            plain.append(word)
            if word.isalpha():
                marked.append(word.lower() + END)
            elif word[:-1].isalpha() and not word[-1].isalnum():
                marked.append(word[:-1].lower() + END + word[-1] + END)
            else:
                marked.append("".join(piece + END for piece in _PIECES.findall(word.lower())))
        if plain:
            ids = self.merges.encode_to_numpy("".join(marked))
            pieces = np.fromiter((m.count(END) for m in marked), np.int64, len(marked))
            last = np.flatnonzero(self.ends[ids])[np.cumsum(pieces) - 1] + 1
            packed, stops = ids.astype(self.dtype).tobytes(), (last * self.dtype.itemsize).tolist()
            self.cache.update(zip(plain, map(packed.__getitem__, map(slice, [0, *stops], stops))))

    def _slice(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.cache) >= CACHE_WORDS:  # words still in use move over from the older generation
            self.older, self.cache = self.cache, {"": b""}
        # Latin letters lower one by one, as the tokenizer does; other texts keep their case here.
        lower = pa.array([t.lower() if _is_latin(t) else t for t in texts], pa.large_string())
        words = pc.split_pattern(pc.replace_substring_regex(lower, "[\t-\r]", " "), " ")
        coded = words.flatten().dictionary_encode()
        known = _strings(coded.dictionary)
        found = list(map(self.cache.get, known))
        lacking = [i for i, packed in enumerate(found) if packed is None]
        for i in lacking:
            if known[i] in self.older:
                self.cache[known[i]] = self.older[known[i]]
        self._learn([known[i] for i in lacking if known[i] not in self.cache])
        for i in lacking:
            found[i] = self.cache[known[i]]
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        ids, first = np.frombuffer(b"".join(found), self.dtype), np.cumsum(size) - size
        order = coded.indices.to_numpy()
        size, first = size[order], first[order]
        stops = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(first - stops[:-1], size) + np.arange(stops[-1])].tobytes()
        cuts = (stops[words.offsets.to_numpy()] * self.dtype.itemsize).tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Packed ids of each whole text, in order; null and empty texts have none."""
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size >= SLICE_CHARS:
                yield from self._slice(some)
                some, size = [], 0
        yield from self._slice(some)


def token_ids(path: str) -> TokenIds:
    """One per worker process and file."""
    if path not in _OPEN:
        _OPEN[path] = TokenIds(path)
    return _OPEN[path]
