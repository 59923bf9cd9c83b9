"""BPE encoding and decoding by dynamic programming over the prefixes of a word.

For each prefix of a word the last token of its encoding is unique, and a token that
ends a prefix is that token exactly when it is compatible with the last token of the
prefix before it: the merges of the two side by side never cross their boundary. So one
pass over a word stores one token a prefix, with candidates from an automaton that
follows suffix links to all tokens ending at a position; back-pointers then give the ids.
No merge list is replayed over the text.

A vocabulary file of the ``tokenizers`` library is read as data; its own normaliser and
splitter cut words into pieces, so that all of the file's rules hold. White space of
ASCII always parts words, and each distinct word of a task is encoded once (a table of
bounded size that only saves time).

Results in special cases: null and empty texts encode to no ids and decode to an empty
text; texts are encoded whole, whatever their length; the strings of special tokens in
a text become those tokens, as the library does; repeated rows get equal results; an
empty table gives an empty result; other columns are handed through by :func:`encode`.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from callgrid.llm.common import WORD

#: Distinct words, and pieces of words, that one Python worker remembers: the last so many at least, twice as many at most.
REMEMBERED_WORDS, REMEMBERED_PIECES = 400_000, 250_000
#: Ids of a vocabulary have no more bits.
_ID_BITS = 24
#: Stands for the end of a word in the automaton; not a character of any byte-level vocabulary.
_END = "￿"


def _byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


_BYTE_CHARS = _byte_chars()


class _Remembered(dict):
    """What ``make`` gives for a key, kept for the keys asked for last. A full table becomes the old one, and keys found
    there move back, so that frequent ones are never made twice."""

    def __init__(self, make: Callable, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Tables of one vocabulary file, and the encoding and decoding built on them."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.text = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text |= {i: t for t, i in self.special.items()}
        self.special_re = re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge: dict[tuple[int, int], int] = {}   # pair of ids: rank
        self.parts: dict[int, tuple[int, int, int]] = {}  # merged id: rank, left, right
        for rank, (a, b) in enumerate(pairs):
            joined = vocab.get(a + b)
            if joined is None:
                continue
            self.merge[vocab[a], vocab[b]] = rank
            self.parts.setdefault(joined, (rank, vocab[a], vocab[b]))
        self._compatible: dict[int, bool] = {}  # by the left id, shifted, and the right one
        self._whole: dict[int, bool] = {}
        #: Ids as little-endian 32-bit integers and decoded text, of a word without ASCII white space and of a piece.
        self.words = _Remembered(self._word, REMEMBERED_WORDS)
        self.pieces = _Remembered(self._piece, REMEMBERED_PIECES)
        self._mark = os.path.commonprefix(list(self.special))  # a word without it holds no special token
        self.automaton = ahocorasick.Automaton()
        for t, i in vocab.items():
            if t in self.special or (i not in self.parts and len(self._chars(t)) > 1):
                continue  # neither a base symbol nor made by a merge: no encoding holds it
            if not self.whole(i):
                continue
            key = t[: -len(self.suffix)] + _END if self.suffix and t.endswith(self.suffix) and t != self.suffix else t
            self.automaton.add_word(key, (i, len(key)))
        self.automaton.make_automaton()
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        # a file that lower-cases, splits by one pattern and maps bytes needs no library call for plain words
        norm, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        self.split = None
        if [n["type"] for n in norm.get("normalizers", ())] == ["NFC", "Replace", "Lowercase"] and [
                (p["type"], p.get("behavior"), p.get("invert"), p.get("add_prefix_space"), p.get("use_regex")) for p in pre.get("pretokenizers", ())] == [
                ("Split", "Removed", True, None, None), ("ByteLevel", None, None, False, False)]:
            self.split = regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"])

    def _chars(self, token: str) -> str:
        return token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token

    def compatible(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' joined text is just these two tokens.

        Undo merges of the two from the latest back; whenever the tokens that then touch at
        the boundary have a merge of their own that comes before the one undone last, it
        would have been applied instead. Of equal ranks the left one is applied first.
        """
        known = self._compatible.get(left << _ID_BITS | right)
        if known is not None:
            return known
        a, b, undone, of_right = left, right, 1 << 60, False
        ok = True
        while True:
            rank = self.merge.get((a, b))
            if rank is not None and (rank < undone or (of_right and rank == undone)):
                ok = False
                break
            rank_a, rank_b = self.parts.get(a, (-1,))[0], self.parts.get(b, (-1,))[0]
            if rank_a < 0 and rank_b < 0:
                break
            if rank_a > rank_b:
                undone, of_right, a = rank_a, False, self.parts[a][2]
            else:
                undone, of_right, b = rank_b, True, self.parts[b][1]
        self._compatible[left << _ID_BITS | right] = ok
        return ok

    def whole(self, token: int) -> bool:
        """Whether a token's own text encodes to that token alone: its two halves do, and are not parted before."""
        known = self._whole.get(token)
        if known is None:
            known = True
            if token in self.parts:
                rank, a, b = self.parts[token]
                known = self.whole(a) and self.whole(b) and self._joins_at(a, b, rank)
            self._whole[token] = known
        return known

    def _joins_at(self, a: int, b: int, rank: int) -> bool:
        # like compatible(), but the merge of the two as they stand is the wanted one
        own, left, right, undone, of_right = True, a, b, 1 << 60, False
        while True:
            r = self.merge.get((left, right))
            if not own and r is not None and (r < undone or (of_right and r == undone)):
                return False
            own = False
            rank_a, rank_b = self.parts.get(left, (-1,))[0], self.parts.get(right, (-1,))[0]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                undone, of_right, left = rank_a, False, self.parts[left][2]
            else:
                undone, of_right, right = rank_b, True, self.parts[right][1]

    def piece(self, text: str) -> list[int]:
        """Ids of one piece of text, as the splitter gives it (byte-level characters)."""
        marked = text + _END if self.suffix else text
        last = [0] * len(marked)  # by prefix: its last token, 0 for none
        size = [0] * len(marked)  # and that token's length
        compatible, test = self._compatible, self.compatible
        for end, (token, length) in self.automaton.iter(marked):
            if size[end]:
                continue
            before = end - length
            if before >= 0:
                if not size[before]:
                    continue
                ok = compatible.get(last[before] << _ID_BITS | token)
                if not ok and (ok is not None or not test(last[before], token)):
                    continue
            last[end], size[end] = token, length
        ids, at = [], len(marked) - 1
        while at >= 0:
            if not size[at]:
                raise ValueError(f"the vocabulary has no encoding for {text!r}")
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _made(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def _piece(self, text: str) -> tuple[bytes, str]:
        return self._made(self.piece(text if text.isascii() else "".join([_BYTE_CHARS[x] for x in text.encode("utf-8")])))

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        if self.split and _SIMPLE.fullmatch(text):
            return [self.pieces[p] for p in self.split.findall(text.lower())]
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        pieces = self.splitter.pre_tokenize_str(text) if self.splitter else [(text, None)]
        return [self._made(self.piece(p)) for p, _ in pieces if p]

    def _word(self, word: str) -> tuple[bytes, str]:
        if self.special and self._mark in word:
            parts, at = [], 0
            for m in self.special_re.finditer(word):
                parts += [*self._plain(word[at:m.start()]), self._made([self.special[m[0]]])]
                at = m.end()
            parts += self._plain(word[at:])
        else:
            parts = self._plain(word)
        return parts[0] if len(parts) == 1 else (b"".join([x[0] for x in parts]), " ".join([x[1] for x in parts]))

    def encoded(self, text: str | None) -> list[tuple[bytes, str]]:
        """Ids and decoded text of each word; a word that the normaliser removes has none."""
        return list(map(self.words.__getitem__, _WORDS.findall(text or "")))

    def decode(self, ids) -> str:
        """Text of ids as the library's decode gives it for a file without a decoder: tokens parted by spaces."""
        return " ".join(self.text[i] for i in ids)


#: Visible Latin-1 characters: composed already, and lower-cased one by one.
_SIMPLE = re.compile("[!-~¡-¬®-ÿ]+")
_WORDS = re.compile(WORD)
_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tables of a vocabulary file, built once a Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int) of each whole text in place of a column of that name, if any."""
    docs = docs.drop("ids")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        bpe = load(path)
        for b in batches:
            ids = [np.frombuffer(b"".join([x[0] for x in bpe.encoded(t)]), "<i4") for t in b.column("text").to_pylist()]
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate([*ids, np.empty(0, "<i4")])))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, "ids"])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids."""
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            texts = pa.array([bpe.decode(x or ()) for x in b.column(column).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids (32-bit little-endian) and of the decoded text of every document.

    Encodes and decodes in one pass over each text, so neither ids nor texts leave the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                words = bpe.encoded(t)
                ids = b"".join([x[0] for x in words])
                text = " ".join([x[1] for x in words if x[0]])
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode("utf-8")).hexdigest()))
            n, ids, text = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                                              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
