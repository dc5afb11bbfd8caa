"""Token ids of whole texts, and documents cut into pieces."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lakeops.llm._common import map_batches

#: Fixed value: a pre-tokenizer with this pattern drops white space, so a text's ids are
#: those of its words, and never joins letters with marks.
WORDED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MAX_CACHED_WORD = 64
MAX_CACHE = 1_500_000
AT_ONCE = 4096                 # words given to the tokenizer in one call


def gaps(ids: list) -> Iterator[int]:
    """Places of None."""
    i = -1
    try:
        while True:
            yield (i := ids.index(None, i + 1))
    except ValueError:
        return


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes, filled from the words of
    a batch of texts; beyond ``MAX_CACHE`` entries the later half goes (frequent words
    come early).

    Texts are lower-cased (ASCII) and cut at ASCII white space, and a new word's last
    mark is cut off, where the tokenizer's file shows that this cannot change ids: its
    pattern is ``WORDED``, it lower-cases, and no added token would be made.  With
    other files whole texts are encoded."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        parts = [spec.get("pre_tokenizer") or {}, *((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [])]
        first = next((x for x in parts if x.get("type") == "Split"), {})
        self.worded = (first.get("pattern") == {"Regex": WORDED} and first.get("behavior") == "Removed"
                       and first.get("invert") is True)
        norm = [spec.get("normalizer") or {}, *((spec.get("normalizer") or {}).get("normalizers") or [])]
        self.lowered = any(x.get("type") == "Lowercase" for x in norm)
        self.added = [x["content"].encode().lower() for x in spec.get("added_tokens") or []]

    def words(self, text: str | None) -> list[bytes]:
        raw = (text or "").encode()
        low = raw.lower() if self.lowered else raw
        if not any(x in low for x in self.added):
            raw = low
        return raw.split()

    def learn(self, words: set[bytes]) -> None:
        """Adds the ids of words that are not known yet."""
        marked = [w for w in words if w[-1:] in (b".", b",") and w[:-1].isalpha()]      # ASCII letters only
        todo = [w for w in {x for w in marked for x in (w[:-1], w[-1:])} | (words - set(marked)) if w not in self]
        for at in range(0, len(todo), AT_ONCE):
            part = todo[at:at + AT_ONCE]
            got = self.tokenizer.encode([w.decode() for w in part], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(got.ids, "<u4").tobytes()
            ends = np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(part)), side="right") * 4
            self.update(zip(part, (ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()))))
        self.update([(w, self[w[:-1]] + self[w[-1:]]) for w in marked])

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: none)."""
        if not self.worded:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if t else b""
                    for t in texts]
        if len(self) > MAX_CACHE:
            for w in list(self)[MAX_CACHE // 2:]:
                del self[w]
        split = [self.words(t) for t in texts]
        found = [list(map(self.get, words)) for words in split]
        unknown = [(ids, i, words[i]) for words, ids in zip(split, found) for i in gaps(ids)]
        new = {w for _, _, w in unknown}
        self.learn(new)
        for ids, i, w in unknown:
            ids[i] = self[w]
        out = [b"".join(ids) for ids in found]
        for w in new:
            if len(w) > MAX_CACHED_WORD:
                self.pop(w, None)
                self.pop(w[:-1], None)
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One tokenizer and cache a Python worker."""
    return WordIds(path)


def token_ids(texts: list[str | None], ids: WordIds, eos: int | None) -> list[np.ndarray]:
    """Ids of whole texts (null: empty), each followed by ``eos``."""
    end = b"" if eos is None else np.array([eos], "<u4").tobytes()
    return [np.frombuffer(x + end, "<u4") for x in ids.encode_all(texts)]


def pieces(docs: DataFrame, path: str, seq_len: int, eos: int | None = 0, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document, those longer
    than ``seq_len`` cut into pieces of ``seq_len`` and a shorter last one.
    Without ``eos`` an empty text is one piece of length 0."""
    schema = StructType([docs.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids_crc32", LongType())])

    def make():
        ids = word_ids(path)

        def step(batch):
            row, piece, start, length, crc = [], [], [], [], []
            for i, a in enumerate(token_ids(batch.column(1).to_pylist(), ids, eos)):
                for k, s in enumerate(range(0, max(len(a), 1), seq_len)):
                    p = a[s:s + seq_len]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(len(p))
                    crc.append(zlib.crc32(p))
            return [batch.column(0).take(pa.array(row, pa.int64())), piece, start, length, crc]
        return step

    return map_batches(docs.select("doc_id", text), make, schema)
