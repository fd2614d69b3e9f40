"""Token ids of whole texts, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tierflow.llm.tables import _LET_GO, giving_back, id_as_long, id_as_text

_CACHED = 100_000
#: Characters whose new words are encoded together.
_TOGETHER = 1 << 20
# White space on which Python and the tokenizer might not agree, and letters whose lower case
# depends on what is next to them or is two characters: such texts are encoded whole.
_ODD = re.compile("[\x1c-\x1f\x85\xa0\u0130\u03a3\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Signs next to a comma or full stop make one token run with it. (The pattern begins with the
# rare characters, which is what makes the search quick.)
_SIGN_RUN = re.compile(r"[.,](?:[^\s\w]|_|(?<=[^\s\w].)|(?<=_.))")
END = b"\0\0\0\0"


class Encoder:
    """Ids of a tokenizer that cuts at white space first, so words can be encoded apart.

    Ids come as unsigned 32-bit little-endian bytes, as a plain call gives them: a string of
    a special token in a text becomes that token.
    """

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Ids that end a run of letters; empty if the tokenizer does not mark them.
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[ends] = True
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder for that file."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _learn(self, words: set[str]) -> None:
        """Adds words to the cache. When it is full, words not used since the last time go."""
        if len(self.cache) > _CACHED:
            self.older, self.cache = self.cache, {}
        new = []
        for word in words.difference(self.cache):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.cache[word] = ids
        # A word of letters alone is one run: many are encoded as one text and cut at run ends.
        letters = [w for w in new if w.isalpha()]
        apart = [w for w in new if not w.isalpha()]
        for k in range(0, len(letters), 1024):
            part = letters[k : k + 1024]
            ids = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ids = np.array(ids, "<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            if len(cuts) != len(part) + 1 or cuts[-1] != 4 * len(ids):
                apart += part
                continue
            data = ids.tobytes()
            for word, a, b in zip(part, cuts, cuts[1:]):
                self.cache[word] = data[a:b]
        found = self.tokenizer.encode_batch_fast(apart, add_special_tokens=False)
        for word, encoding in zip(apart, found, strict=True):
            ids = encoding.ids
            self.cache[word] = struct.pack(f"<{len(ids)}I", *ids)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            parts, chars = [], 0
            while at < len(texts) and chars < _TOGETHER:
                text = texts[at]
                whole = any(s in text for s in self.special)
                parts.append((text, None if whole else words_of(text)))
                chars += len(text)
                at += 1
            self._learn(set().union(*[words for _, words in parts if words]))
            found = self.cache.__getitem__
            for text, words in parts:
                if words is None:
                    ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                    out.append(np.array(ids, "<u4").tobytes())
                else:
                    out.append(b"".join(map(found, words)))
        return out


_LET_GO.append(Encoder._open.clear)


def words_of(text: str) -> list[str] | None:
    """What the tokenizer may encode apart, or None if only the whole text is safe.

    It lower-cases and cuts at white space, and between letters and signs, itself; doing
    so before makes for fewer distinct words.
    """
    if _ODD.search(text) or not unicodedata.is_normalized("NFC", text):
        return None
    if not _SIGN_RUN.search(text):
        text = text.replace(",", " , ").replace(".", " . ")
    return text.lower().split()


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(number, start, ids) of a text's pieces: ids and an end id 0, cut only beyond ``capacity``."""
    ids += END
    step = 4 * capacity
    for number, start in enumerate(range(0, len(ids), step)):
        yield number, start // 4, ids[start : start + step]


def pieces(rows: DataFrame, path: str, capacity: int) -> DataFrame:
    """A row for each piece of ``(_row, doc_id, text)``; an empty text is one piece, its end id."""

    @giving_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder.of(path)
        for batch in batches:
            out = []
            encoded = encoder.encode_many(batch["text"].tolist())
            for row, doc, ids in zip(batch["_row"], batch["doc_id"], encoded, strict=True):
                for number, start, part in pieces_of(ids, capacity):
                    out.append((row, doc, number, start, len(part) // 4, zlib.crc32(part)))
            found = pd.DataFrame(
                out, columns=["_row", "doc_id", "piece", "start", "length", "ids_crc32"]
            )
            yield found

    out = id_as_text(rows, "doc_id").mapInPandas(
        run, "_row long, doc_id string, piece int, start long, length long, ids_crc32 long"
    )
    return id_as_long(out, "doc_id")
