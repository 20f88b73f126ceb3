"""Byte-pair encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a block form a trie. It is walked depth first; every node (a prefix) keeps only the last
token of its encoding. The encoding of a prefix is the encoding of what is before its last token, plus that token,
so a node's state follows from its ancestors' and is computed once for all words that share the prefix.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tesserae.llm.blocks import cuts

#: How byte-level vocabularies split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+").findall
RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """Encodes and decodes with a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, keep_words: int = 900_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
        if spec.get("normalizer") or not plain or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path} is no plain byte-level BPE file: its ids would come out wrong")
        names = _byte_names()
        as_bytes = lambda s: bytes(names[c] for c in s)
        vocab = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.merged: dict[tuple[int, int], int] = {}  # pair -> rank of its merge
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> rank of its merge, left, right
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            a, b = vocab[left], vocab[right]
            self.merged.setdefault((a, b), rank)
            self.parts.setdefault(vocab[left + right], (rank, a, b))
        self.vocab = vocab
        ends: dict[bytes, set[int]] = {}
        for token in vocab:
            if len(token) > 2:
                ends.setdefault(token[-3:], set()).add(len(token))
        #: Lengths of the tokens that end in three bytes, longest first, then 2 and 1.
        self.lengths = {tail: (*sorted(found, reverse=True), 2, 1) for tail, found in ends.items()}
        self.words = regex.compile(WORDS).findall
        self.around = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.keep_words = keep_words

    def stays(self, a: int, b: int) -> bool:
        """Whether ``a`` then ``b`` stay two tokens: no merge across the border comes before what built them.

        Taking the two tokens apart from the last merge backwards shows every pair of neighbours that ever met at
        the border, and until when they were neighbours.
        """
        key = a << 20 | b
        if (known := self.pairs.get(key)) is not None:
            return known
        parts, merged, until = self.parts, self.merged, 1 << 40
        x, y = a, b
        left_edge = False  # the undone merge stood right of the border: equal ranks were then won by the left
        ok = True
        while True:
            rank = merged.get((x, y))
            if rank is not None and (rank < until or (rank == until and not left_edge)):
                ok = False
                break
            rx = parts[x][0] if x in parts else -1
            ry = parts[y][0] if y in parts else -1
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                until, x, left_edge = rx, parts[x][2], True
            else:
                until, y, left_edge = ry, parts[y][1], False
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words: depth-first over their trie, here in sorted order so that the path is a stack."""
        vocab, lengths, stays, pairs = self.vocab.get, self.lengths.get, self.stays, self.pairs.get
        before = b""
        last: list[int] = [-1]  # last token of the path's prefix of each length
        size: list[int] = [0]
        for word, name in sorted((w.encode("utf-8"), w) for w in words):
            n, shared = len(word), 0
            most = min(len(before), n)
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, n + 1):
                for length in lengths(word[end - 3 : end], (2, 1)) if end > 2 else (2, 1):
                    start = end - length
                    if start < 0 or (token := vocab(word[start:end])) is None:
                        continue
                    ok = False
                    if start == 0 or ((ok := pairs(last[start] << 20 | token)) is None and stays(last[start], token)) or ok:
                        last.append(token)
                        size.append(length)
                        break
                else:
                    raise ValueError("no token for a byte")
            ids, at = [], n
            while at:
                ids.append(last[at])
                at -= size[at]
            self.known[name] = b"".join(i.to_bytes(4, "little") for i in reversed(ids))
            before = word

    def pieces(self, text: str) -> list[str]:
        """Parts that encode alike anywhere: white space and what follows it. Rare white space: the whole text."""
        return PIECES(text) if RARE_SPACE(text) is None else [text]

    def _parts(self, text: str) -> list[str]:
        if self.around is None or not any(s in text for s in self.special):
            return self.pieces(text)
        return [x for part in self.around.split(text) for x in ((part,) if part in self.special else self.pieces(part))]

    def _learn_pieces(self, new: set[str]) -> None:
        split = {piece: self.words(piece) for piece in new}
        self.learn({w for words in split.values() for w in words}.difference(self.known))
        for piece, words in split.items():
            self.known_pieces[piece] = b"".join(map(self.known.__getitem__, words))
        for s, i in self.special.items():
            self.known_pieces[s] = i.to_bytes(4, "little")

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers.

        The words that no text before had go through one trie. What is kept of earlier blocks is bounded by
        ``keep_words``; beyond that it is forgotten and computed again.
        """
        if len(self.known) + len(self.known_pieces) > self.keep_words:
            self.known.clear()
            self.known_pieces.clear()
        parts = [self._parts(text) for text in texts]
        new = set().union(*parts).difference(self.known_pieces)
        if new:
            self._learn_pieces(new)
        found = self.known_pieces.__getitem__
        return [b"".join(map(found, x)) for x in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become replacement characters."""
        found = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, found)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def encode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", block_bytes: int = 2 << 20) -> DataFrame:
    """Token ids and decoded text of every row: ``key, token_ids`` (packed little-endian uint32), ``decoded``.

    ``path`` is read on each executor. Null and empty texts give no ids and an empty text. Rows keep their number
    and may repeat; other columns of ``docs`` are left out, so their names cannot clash.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for block in cuts(batches, "text", block_bytes):
            ids = bpe.encode_all(block.column("text").to_pylist())
            decoded = [bpe.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["key", "token_ids", "decoded"],
            )

    out = rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, token_ids binary, decoded string")
    return out.withColumnRenamed("key", key)
