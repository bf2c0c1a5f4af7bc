"""Token ids of whole texts by a public word-level BPE vocabulary, cached per distinct word.

The vocabulary lower-cases, drops white space and cuts nothing across it, so a
text's ids are the ids of its white-space separated parts, one after the other. Parts
repeat: Arrow finds the distinct ones of some texts, each is looked up once, and the ids
of all of them are taken by place. Each worker encodes a distinct part once and keeps its ids as bytes.
A part of common letters, digits and signs is cut into its pieces as the vocabulary cuts it, so a word
is encoded once whatever signs it stands in. Pieces not met before are encoded many at a time, as one text
with spaces between them: the last id of a piece, and no other, is one of a word's end. Other parts are
encoded as one text in which the name of a special token stands between them.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.common import KEPT, one

END_ID = 2
CACHE_PARTS = 1_000_000  # parts kept by a worker; beyond that only the short ones stay
# White space by which Arrow's split cuts is fixed: ``[\x20\x09-\x0D]``; the
# pre-tokenizer drops all of it.
_LONG = 200  # bytes; longer parts are encoded but not kept
_SHORT = 9  # bytes of parts that stay when the cache is full: the frequent ones
_AT_ONCE = 1 << 20  # bytes of text cut into parts at once
_TOGETHER = 256  # parts encoded as one text
_SEPARATOR = "<|endoftext|>"  # fixed value: a special token of the vocabulary
_WORD_END = "</w>"  # fixed value: the vocabulary's mark of a word's last token
# Letters that stay one letter each when composed and lower-cased: ASCII, Latin-1, Latin Extended-A without
# U+0130, and Cyrillic to U+047F.
_LETTERS = r"A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F\u0400-\u047F"
_WORD = re.compile(f"[{_LETTERS}]+")
_PLAIN = re.compile(f"[!-~{_LETTERS}]*")
# Fixed value: the vocabulary's rule, for the characters of _PLAIN.
_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[!-/:-@\[-`{{-~]+")


class PartEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith(_WORD_END)]] = True
        self.cache: dict[bytes, bytes] = {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without the end."""
        # Names of special tokens are cased, and looked for first; letters are composed with marks (U+0300 to
        # U+037F, bytes CC and CD) before they are lower-cased, and some only compose when small.
        cased = pa.array([t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts], pa.large_binary())
        parts = pc.ascii_split_whitespace(cased.view(pa.large_string()))
        coded = parts.values.dictionary_encode()
        distinct = _values(coded.dictionary)
        found = list(map(self.cache.get, distinct))
        missing = [p for p, x in zip(distinct, found) if x is None]
        if missing:
            new = self._learn(missing)
            found = [new[p] if x is None else x for p, x in zip(distinct, found)]
        return _values(pa.array(found, pa.large_binary()).take(coded.indices), parts.offsets.to_numpy())

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        """Ids of the missing parts, which the cache keeps unless they are long."""
        words, cut, odd = [], {}, []
        for p in missing:
            text = p.decode()
            if _WORD.fullmatch(text):
                words.append(p)
            elif "<|" not in text and _PLAIN.fullmatch(text):
                cut[p] = [x.encode() for x in _PIECE.findall(text.lower())]
            else:
                odd.append(p)
        known = self.cache
        more = {x for x in chain.from_iterable(cut.values()) if x not in known}
        words.extend(more.difference(words))
        new = dict(zip(words, self._encode(words)))
        new.update([(p, b"".join([new[x] if x in new else known[x] for x in pieces])) for p, pieces in cut.items()])
        new.update(zip(odd, self._encode_apart(odd)))
        kept = {p: x for p, x in new.items() if len(p) <= _LONG}
        if len(self.cache) + len(kept) > CACHE_PARTS:
            self.cache = {p: x for p, x in self.cache.items() if len(p) <= _SHORT}
            if len(self.cache) + len(kept) > CACHE_PARTS:
                self.cache = {}
        self.cache.update(kept)
        return new

    def _encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece that the vocabulary doesn't cut."""
        chunks = [pieces[i : i + _TOGETHER] for i in range(0, len(pieces), _TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([b" ".join(c).decode() for c in chunks], add_special_tokens=False)
        out = []
        for chunk, encoding in zip(chunks, joined):
            ids = np.array(encoding.ids, "<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            raw = ids.tobytes()
            if len(cuts) == len(chunk):
                out.extend([raw[a:b] for a, b in zip([0, *cuts], cuts)])
            else:  # a vocabulary without ends of words
                out.extend(self._encode_apart(chunk))
        return out

    def _encode_apart(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part. A part with the mark of special tokens in it is a text of its own."""
        plain = [p for p in parts if b"<|" not in p]
        chunks = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([_SEPARATOR.join(p.decode() for p in c) for c in chunks], add_special_tokens=False)
        out = {}
        for chunk, encoding in zip(chunks, joined):
            ids = np.array(encoding.ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator)
            raw = ids.tobytes()
            starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)]
            out.update((p, raw[a:b]) for p, a, b in zip(chunk, starts, ends, strict=True))
        odd = [p for p in parts if b"<|" in p]
        alone = self.tokenizer.encode_batch_fast([p.decode() for p in odd], add_special_tokens=False)
        out.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(odd, alone))
        return [out[p] for p in parts]


def _values(array: pa.Array, cuts: np.ndarray | None = None) -> list[bytes]:
    """Values of a large text or binary array from its start, or what lies between each two of the cuts, joined."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64, len(array) + 1)
    at = (at if cuts is None else at[cuts]).tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in zip(at, at[1:])]


def encoder(path: str) -> PartEncoder:
    """The worker's encoder for a vocabulary file, kept until the worker gets tasks of another step."""
    if path not in KEPT:
        KEPT[path] = PartEncoder(path)
    return KEPT[path]


def encoded(path: str, texts_column) -> Iterator[bytes]:
    """Ids of each text with the end id, as bytes."""
    own, end = encoder(path), END_ID.to_bytes(4, "little")
    array = one(texts_column)
    array = array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary())
    some, size = [], 0
    for text in (x.as_py() for x in array):
        some.append(text)
        size += len(text)
        if size >= _AT_ONCE:
            yield from (ids + end for ids in own.ids(some))
            some, size = [], 0
    yield from (ids + end for ids in own.ids(some))


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
