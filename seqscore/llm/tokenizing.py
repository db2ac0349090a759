"""Whole-text tokenization with a published byte-level BPE vocabulary."""

from __future__ import annotations

import re
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A worker remembers the words of the current generation and of the one before.
# A generation ends with so many words, or so many bytes of words and ids; words
# of the former that are met again move on, the others are forgotten.  This
# bounds memory only, never a result.
GENERATION_WORDS, GENERATION_BYTES = 200_000, 12_000_000
# The tokenizer takes longer for a word the longer its input is.
WORDS_PER_INPUT = 64

_BREAK = re.compile(r" \s")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class TextEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The vocabulary's own splitting always cuts in front of a space that a
    non-space follows, so the ids of a text are those of its space-separated
    words, each taken with its leading space.  Each different word of a batch
    is looked up once; words met before are not encoded again, new ones are
    encoded together.  Texts in which white space follows a space, or that end
    in one, go to the tokenizer whole; so do all texts of a vocabulary that
    doesn't split in front of spaces."""

    _shared: dict[str, TextEncoder] = {}

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        """One encoder for each vocabulary and Python worker."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._words: dict[str, bytes] = {}
        self._former: dict[str, bytes] = {}
        self._bytes = 0
        self._by_word = self._splits_at_spaces()
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        size = self._tok.get_vocab_size()
        self.id_bytes = 2 if size <= 1 << 16 else 4
        # bytes of text that each id stands for: one character of the
        # byte-level alphabet is one byte
        self._width = np.zeros(size, np.int64)
        for piece, i in self._tok.get_vocab().items():
            self._width[i] = len(piece)

    def _splits_at_spaces(self) -> bool:
        """Whether words can be encoded apart: a space that a non-space follows
        starts a new piece, and the text is not changed before."""
        probe = "a b1 2, c.é  漢 x"
        if self._tok.normalizer is not None or self._tok.pre_tokenizer is None:
            return False
        starts = {at for _, (at, _) in self._tok.pre_tokenizer.pre_tokenize_str(probe)}
        return all(i in starts for i, c in enumerate(probe[:-1]) if c == " " and probe[i + 1] != " ")

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of new ``words`` (none holds a space or is empty)."""
        found: list[bytes] = []
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            inputs = [" " + " ".join(part[i:i + WORDS_PER_INPUT]) for i in range(0, len(part), WORDS_PER_INPUT)]
            raw, packed = "".join(inputs).encode(), b"".join(self._whole(inputs))
            blanks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)
            ends = np.cumsum(self._width[np.frombuffer(packed, "<u4")])
            cut = [*(4 * np.searchsorted(ends, blanks, "right")).tolist(), len(packed)]
            found.extend([packed[a:b] for a, b in pairwise(cut)])
            self._bytes += len(raw) + len(packed)
        return found

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of different words, each with a space in front."""
        if len(self._words) > GENERATION_WORDS or self._bytes > GENERATION_BYTES:
            self._words, self._former, self._bytes = {}, self._words, 0
        ids = list(map(self._words.get, words))
        fresh = [w for w, i in zip(words, ids, strict=True) if i is None]
        former = list(map(self._former.get, fresh))
        self._bytes += sum([len(w) + len(i) for w, i in zip(fresh, former, strict=True) if i is not None])
        learned = iter(self._learn([w for w, i in zip(fresh, former, strict=True) if i is None]))
        known = [next(learned) if i is None else i for i in former]
        self._words.update(zip(fresh, known, strict=True))
        rest = iter(known)
        return [next(rest) if i is None else i for i in ids]

    def encode(self, texts: list[str]) -> list[bytes]:
        # what is encoded apart (the first word has no space before it), and
        # what follows as words
        first: list[str] = []
        rest: list[str | None] = []
        for t in texts:
            if not self._by_word or t.endswith(" ") or _BREAK.search(t) or any(s in t for s in self._special):
                head, blank, tail = t, "", ""
            else:
                head, blank, tail = t.partition(" ")
            first.append(head)
            rest.append(tail if blank else None)
        split = pc.split_pattern(pa.array(rest, pa.large_string()), pattern=" ")
        words = split.values.dictionary_encode()
        ids = pa.array(self._ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(words.indices)
        starts = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        cut = starts[split.offsets.to_numpy()].tolist()
        packed = memoryview(ids.buffers()[2] or b"")
        return [b"".join((head, packed[a:b])) for head, (a, b) in zip(self._whole(first), pairwise(cut), strict=True)]


def blocks(texts: list[str], chars: int = 1_000_000):
    """Ranges of consecutive texts of about ``chars`` characters, for ``encode``."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if i > start and held + len(t) > chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
