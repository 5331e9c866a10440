"""Token ids of whole texts with a public tokenizer file, word by word where that is exact.

A tokenizer that drops white space and ends words (BPE with a word suffix)
gives a text the ids of its blank-separated words one after the other. Such
words repeat, so their ids are kept in a bounded table of the worker and
only words not seen yet go through the tokenizer. Other tokenizers get
whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.common import binary_list, doc_texts, slices

VOCABULARY = "word_bpe_49k.json"
#: Id appended to every document.
END_ID = 1
#: Bounds of a worker's word table: entries, and length of a word worth keeping.
MAX_WORDS, MAX_WORD_BYTES = 500_000, 64
#: The lower letters of ASCII and Latin-1, and words of nothing else.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
PLAIN = re.compile(b"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts (UTF-8) to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.word_wise = bool((spec.get("model") or {}).get("end_of_word_suffix")
                              and pre[0].get("type") == "Split" and pre[0].get("invert")
                              and pre[0].get("behavior") == "Removed")
        # Words met so far, in two generations: a full younger one becomes the older one, and words of the older
        # one that are met again move up, so words in use are kept.
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # Lower letters of Latin-1 are what the tokenizer's normalizer and cutting leave as they are; the model
        # gets them as the signs that stand for their bytes.
        steps = [x.get("type") for x in pre]
        self.model = self.tokenizer.model if self.word_wise and steps == ["Split", "ByteLevel"] else None
        if self.model is not None:
            signs = ByteLevel(add_prefix_space=False, use_regex=False)
            self.signs = {ord(c): signs.pre_tokenize_str(c)[0][0] for c in LETTERS}

    def _encode(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids
        return array("I", ids).tobytes() if _NATIVE else np.asarray(ids, "<u4").tobytes()

    def _encode_word(self, word: bytes) -> bytes:
        if self.model is None or not PLAIN.fullmatch(word):
            return self._encode(word)
        return self._encode_letters(word)

    def _encode_letters(self, word: bytes) -> bytes:
        """The ids of a PLAIN word; ASCII letters are their own signs."""
        text = word.decode()
        found = self.model.tokenize(text if word.isascii() else text.translate(self.signs))
        ids = [t.id for t in found]
        return array("I", ids).tobytes() if _NATIVE else np.asarray(ids, "<u4").tobytes()

    def _known(self, word: bytes) -> bytes:
        """The ids of a word that the younger words lack.

        The tokenizer lowers letters and cuts between letters and a full stop or
        comma after them, so "Word." has the ids of "word" and of "." (a text that
        could hold a special token is left as it is).
        """
        ids = self.young.get(word)
        if ids is not None:
            return ids
        ids = self.old.get(word)
        if ids is None:
            plain = word if b"<|" in word else word.lower()
            if plain[-1:] in (b".", b",") and plain[-2:-1].isalnum() and plain[-2] < 128 and b"<|" not in plain:
                ids = self._known(plain[:-1]) + self._known(plain[-1:])
            else:
                ids = self._known(plain) if plain != word else self._encode_word(word)
        if len(word) <= MAX_WORD_BYTES:
            if len(self.young) >= MAX_WORDS // 2:
                self.young, self.old = {}, self.young
            self.young[word] = ids
        return ids

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words."""
        out = list(map(self.young.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                word = words[i]
                if self.model is None or len(word) > MAX_WORD_BYTES or not PLAIN.fullmatch(word):
                    out[i] = self._known(word)
                    continue
                # Lower letters alone are what most new words are: nothing of them to fold or to cut off.
                ids = out[i] = self.old.get(word) or self._encode_letters(word)
                if len(self.young) >= MAX_WORDS // 2:
                    self.young, self.old = {}, self.young
                self.young[word] = ids
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as bytes."""
        return self.encode_column(pa.array([t.decode("utf-8") for t in texts], pa.string()))

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a string column as bytes."""
        if not self.word_wise:
            return [self._encode(t) for t in binary_list(texts)]
        texts = pa.compute.fill_null(texts, "")
        special = pa.compute.match_substring(texts, "<|")
        if pa.compute.any(special).as_py():
            plain = iter(self._encode_plain(texts.filter(pa.compute.invert(special))))
            return [self._encode(t.as_py().encode()) if x else next(plain) for t, x in zip(texts, special.to_pylist())]
        return self._encode_plain(texts)

    def _encode_plain(self, texts: pa.Array) -> list[bytes]:
        """The ids of texts without special tokens: lowered, full stops and commas after words cut off, words looked up
        once each. The six ASCII blanks are white space to the tokenizer."""
        texts = pa.compute.replace_substring_regex(pa.compute.ascii_lower(texts), r"([a-z0-9])([.,])(\s|$)", r"\1 \2\3")
        split = pa.compute.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids = self.word_ids(binary_list(coded.dictionary))
        body = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = length[at]
        ends = np.cumsum(n)
        starts = (np.cumsum(length) - length)[at]
        # Places in `body` of all ids: a word's first one, and steps of one after it (in 32 bits: a batch is small).
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(body)) < 1 << 31 else np.int64
        place = np.repeat((starts - (ends - n)).astype(kind), n)
        place += np.arange(total, dtype=kind)
        stream = body[place].tobytes()
        bounds = (4 * np.concatenate(([0], ends))[split.offsets.to_numpy()]).tolist()
        return [stream[a:b] for a, b in zip(bounds, bounds[1:])]

    @lru_cache(maxsize=4)
    def sentence_enders(self, marks: str = ".!?…。！？") -> np.ndarray:
        """Ids of the vocabulary entries made of sentence marks only."""
        inner = {x for m in marks for x in self.tokenizer.encode(m, add_special_tokens=False).tokens}
        plain = {x.removesuffix("</w>") for x in inner}
        found = [i for t, i in self.tokenizer.get_vocab().items()
                 if t.endswith("</w>") and (t in inner or (t[:-4] and set(t[:-4]) <= plain))]
        return np.array(sorted(found), np.uint32)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file (its word table outlives a task)."""
    return Encoder(path)


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) dealt by ranges of doc_id and sorted in each partition.

    The text's hash is the second key and the row's number the third, so that an id with very many rows, equal
    ones too, spreads over several partitions; hash and text make the order definite.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (doc_texts(docs).withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
            .repartitionByRange(n, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "text")
            .select("doc_id", "text"))


def encoded(batches: Iterator[pa.RecordBatch], path: str,
            end_id: int = END_ID) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """(doc_ids, ids of each with the end id as bytes) of Arrow batches of (doc_id, text)."""
    enc = encoder(path)
    end = np.array([end_id], "<u4").tobytes()
    for b in slices(batches, "text", 3 << 20):
        yield b.column("doc_id").to_pylist(), [x + end for x in enc.encode_column(b.column("text"))]
