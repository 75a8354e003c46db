"""Token ids of whole texts, inside Spark tasks: the words of some texts at a
time are numbered by Arrow, and only distinct words are looked up or encoded."""

from __future__ import annotations

import gc
import os
import struct
import sys
from collections.abc import Callable, Iterator
from functools import lru_cache
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lendwise.llm.common import HELD

#: Vocabulary size of the production tokenizer and the id that ends a document.
VOCABULARY, END_ID = 49_408, 1
TOKENIZER = "word_bpe_49k.json"
#: Text bytes encoded at a time; a longer text is encoded by itself. More are faster, fewer take less memory.
SPAN = 4 << 20


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Fixed rule: a word of Latin-1 letters, and a mark that the production tokenizer always makes a piece of its own after letters.
LETTERS = "A-Za-z" + "".join(chr(c) for c in range(0x80, 0x100) if chr(c).isalpha())
MARKS = ".,;:!?"
LETTERS_AND_MARK = f"^(?P<letters>[{LETTERS}]+)(?P<mark>[{MARKS}]?)$"
#: Byte-level alphabet (fixed rule): printable bytes stand for themselves, the others for 256, 257, ... in order.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_LEVEL = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


@lru_cache(maxsize=256)
def packer(n: int) -> Callable[..., bytes]:
    """Packs ``n`` ids as little-endian unsigned 32-bit numbers."""
    return struct.Struct(f"<{n}I").pack


class Recent(dict):
    """A memory of about ``2 * keep`` entries in two generations: what is not
    used while ``keep`` others come is forgotten."""

    def __init__(self, keep: int):
        super().__init__()
        self.keep, self.old = keep, {}

    def age(self) -> None:
        if len(self) > self.keep:
            self.old = dict(self)
            self.clear()

    def unknown(self, keys: list) -> list:
        """The keys that are in neither generation; the others are made young."""
        missing, old = [k for k in keys if k not in self], self.old
        if old:
            self.update((k, old[k]) for k in missing if k in old)
            missing = [k for k in missing if k not in old]
        return missing


class WordEncoder:
    """Encodes texts with a tokenizer that lower-cases, drops white space and
    never merges across it, nor across letters and a closing mark. So the ids
    of a text are those of its words in a row, and those of a word of
    Latin-1 letters are those of its lower-case letters and its mark (checked
    against whole-text encoding in the tests). Only a bounded memory of recent
    words is kept, however many there are."""

    def __init__(self, path: str, keep: int = 50_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.longest = longest
        self.known = Recent(keep)

    def _blobs(self, parts: list[str], letters: bool) -> list[bytes]:
        """Packed ids of distinct parts: lower-case Latin-1 letters, each one piece, or any words. Python's cyclic
        collector pauses meanwhile: nothing here makes cycles, and it would walk all that is held again and again."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._learnt(parts, letters)
        finally:
            if collects:
                gc.enable()

    def _learnt(self, parts: list[str], letters: bool) -> list[bytes]:
        known = self.known
        new = known.unknown(parts)
        if letters:
            for p in new:
                ids = [x.id for x in self.merge(p if p.isascii() else p.encode().decode("latin-1").translate(BYTE_LEVEL))]
                known[p] = packer(len(ids))(*ids)
        else:
            for at in range(0, len(new), 10_000):
                some = new[at:at + 10_000]
                for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                    known[p] = packer(len(e))(*e.ids)
        out = [known[p] for p in parts]
        for p in new:
            if len(p) > self.longest:  # rare, and large: not kept
                del known[p]
        return out

    def _words(self, words: pa.Array) -> pa.Array:
        """Lists of ids of distinct words."""
        found = pc.extract_regex(words, LETTERS_AND_MARK)
        plain = found.is_valid()
        letters = pc.utf8_lower(found.field("letters").filter(plain)).dictionary_encode()
        marks, odd = pc.index_in(found.field("mark").filter(plain), pa.array(list(MARKS), pa.large_string())), words.filter(pc.invert(plain))
        names = letters.dictionary.to_pylist()
        blobs = self._blobs(names, True)
        blobs += self._blobs(odd.to_pylist(), False) + self._blobs(list(MARKS), False) + [b""]
        lists = lists_of(np.frombuffer(b"".join(blobs), "<u4"), np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4)
        # Each word is two parts: its letters and its mark or nothing, or all of it and nothing.
        part = np.full((len(words), 2), len(blobs) - 1, np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        part[is_plain, 0] = letters.indices.to_numpy()
        part[is_plain, 1] = len(names) + len(odd) + marks.fill_null(len(MARKS)).to_numpy()
        part[~is_plain, 0] = len(names) + np.arange(len(odd))
        both = lists.take(pa.array(part.reshape(-1)))
        return pa.LargeListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)

    def spans(self, texts: pa.Array, span: int = SPAN) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Yields (ids, offsets of each text and the end) of some texts at a time; null texts are empty."""
        size = np.append(0, np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)))
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(size, size[a] + span, "right")) - 1)
            self.known.age()
            # An empty word, before or after white space, has no ids.
            words = pc.ascii_split_whitespace(texts.slice(a, b - a).cast(pa.large_string()).fill_null(""))
            first, flat = words.offsets.to_numpy(), words.values.dictionary_encode()
            ids = self._words(flat.dictionary).take(flat.indices)
            yield ids.values.to_numpy(), ids.offsets.to_numpy()[first]
            a = b

    def documents(self, texts: pa.Array, end_id: int, span: int = SPAN) -> Iterator[np.ndarray]:
        """The ids of each text and an end."""
        for ids, offsets in self.spans(texts, span):
            ends = offsets[1:] + np.arange(len(offsets) - 1)
            out, own = np.full(len(ids) + len(ends), end_id, "<u4"), np.ones(len(ids) + len(ends), bool)
            own[ends] = False
            out[own] = ids
            yield from np.split(out, ends[:-1] + 1)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        return b"".join(ids.tobytes() for ids, _ in self.spans(pa.array([text], pa.large_string())))


def lists_of(values: np.ndarray, lengths: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths))), pa.array(values, pa.uint32()))


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which runs many tasks: what it has
    learned serves the next task."""
    held = sys.modules.setdefault(HELD, ModuleType(HELD))
    if path not in vars(held):
        setattr(held, path, WordEncoder(path))
    return getattr(held, path)
