"""Byte-level BPE encoding and decoding.

Encoding. A text is split as the vocabulary's pre-tokenizer does; every piece is encoded by backtracking over
longest matches. One Aho-Corasick pass gives the longest token at each byte; going left to right, a token is
taken if it may follow the token before it, else its longest prefix that is a token is tried, else the token
before it is given up and its end marked as dead, so no position is left more than once and the work is linear.
Two tokens may stand together if merging their bytes anew yields just these two; this pair table fills up as
pairs are met. The result is exactly that of applying the merges in order of rank.

Decoding looks the ids up in a table of offsets into one string of all tokens' bytes. Byte sequences that are
not UTF-8 become U+FFFD.

A worker keeps the encodings of the pieces it has met in two generations of at most CACHED pieces: when the
younger is full it becomes the older one, and pieces that come up again are taken over from there. Longer pieces than
CACHED_LENGTH are kept within their text only, and the pair table starts anew at ALLOWED pairs, so that what a worker
keeps has a bound in bytes.

Defined cases. Null or empty text: no ids, empty text. Special tokens written out in a text become their ids.
Null ids column: empty text; ids outside the vocabulary are an error. Repeated rows: encoded alike. Empty
table: empty result. Texts of any length are encoded whole. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridcast.llm.packing import byte_values

CACHED = 400_000
CACHED_LENGTH = 64
ALLOWED = 500_000
PART_BYTES = 1 << 20

#: Fixed value: how byte-level vocabularies split a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        value = byte_values()
        words = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: bytes(value[c] for c in t) for t, i in words.items() if t not in self.special}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}  # pair: rank and id of what it becomes
        self.halves: dict[int, tuple[int, int, int]] = {}  # id: rank of the merge that makes it, and its halves
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pair, whole = (words[a], words[b]), words[a + b]
            self.merged.setdefault(pair, (rank, whole))
            self.halves.setdefault(whole, (rank, *pair))
        # A token that its own merges do not yield never comes out of an encoding.
        made = {i for i, t in self.tokens.items() if len(t) == 1} | set(self.halves)
        self.finder = ahocorasick.Automaton()
        by_bytes = {}
        for i in sorted(made):
            by_bytes[self.tokens[i]] = i
            self.finder.add_word(self.tokens[i].decode("latin-1"), (i, len(self.tokens[i]) - 1))
        self.finder.make_automaton()
        self.whole = by_bytes
        self.size = {i: len(self.tokens[i]) for i in made}
        self.shorter: dict[int, int | None] = {}
        for i in made:
            t = self.tokens[i]
            self.shorter[i] = next((by_bytes[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in by_bytes), None)
        self.allowed: dict[tuple[int, int], bool] = {}
        last = max([*self.tokens, *self.special.values()])
        table = [self.tokens.get(i, b"") for i in range(last + 1)]
        for content, i in self.special.items():
            table[i] = content.encode()
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.pieces = regex.compile(PIECES)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, str] = {}
        self.older: dict[str, str] = {}

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave the bytes of two neighbours as these two tokens.

        Seen from the border, the left token grows by its chain of right halves, the right one by its chain of
        left halves. Undoing the merges that touch the border from the latest back, the two tokens beside it
        must never have a merge of their own that would have come before the next one in the chains.
        """
        got = self.allowed.get((left, right))
        if got is None:
            if len(self.allowed) >= ALLOWED:
                self.allowed.clear()
            got = self.allowed[left, right] = self._stays_apart(left, right)
        return got

    def _stays_apart(self, left: int, right: int) -> bool:
        # The merges that made each side's border token: a step is undone on the side whose merge is the later.
        # On equal ranks the left one is done first, so the right one is undone first.
        never = (1 << 60, 1)
        limit = never
        while True:
            own = self.merged.get((left, right))
            if own and (own[0], 0) < limit:
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                limit, left = (a[0], 0), a[2]
            else:
                limit, right = (b[0], 1), b[1]

    def encode_piece(self, piece: bytes) -> list[int]:
        if (only := self.whole.get(piece)) is not None:
            return [only]
        longest: list[int | None] = [None] * (len(piece) + 1)
        for end, (token, back) in self.finder.iter(piece.decode("latin-1")):
            longest[end - back] = token  # later ends come later, so the longest stays
        size, shorter, allowed = self.size, self.shorter, self.allowed
        out: list[int] = []
        alive = [True] * (len(piece) + 1)
        at, token = 0, longest[0]
        while token is not None:
            before = out[-1] if out else None
            while True:
                end = at + size[token]
                if alive[end]:
                    fits = True if before is None else allowed.get((before, token))
                    if self.may_follow(before, token) if fits is None else fits:
                        out.append(token)
                        at, token = end, longest[end]
                        break
                if shorter[token] is not None:
                    token = shorter[token]
                    continue
                alive[at] = False
                out.pop()
                at -= size[before]
                token = before
                break
        return out

    def decimal(self, text: str) -> str:
        """The ids of a text, joined by commas."""
        if self.specials and self.specials.search(text):
            parts = [str(self.special[p]) if p in self.special else self.decimal(p) for p in self.specials.split(text) if p]
            return ",".join(parts)
        pieces = self.pieces.findall(text)
        if len(self.known) >= CACHED:
            self.known, self.older = {}, self.known
        known, older, passing = self.known, self.older, {}
        for p in set(pieces).difference(known):
            keep = known if len(p) <= CACHED_LENGTH and len(known) < CACHED else passing
            keep[p] = older.get(p) or ",".join(map(str, self.encode_piece(p.encode())))
        if passing:
            return ",".join([known.get(p) or passing[p] for p in pieces])
        return ",".join(map(known.__getitem__, pieces))

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's bytes begin (one more at the end)."""
        lengths = self.lengths[ids]
        begins = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.offsets[ids] - begins[:-1], lengths) + np.arange(begins[-1])
        return self.bytes[at].tobytes(), begins


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _numbers(decimal: str) -> np.ndarray:
    return np.fromstring(decimal, np.int64, sep=",") if decimal else np.zeros(0, np.int64)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns id and ids (array of int)."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path)
        for b in batches:
            rows = [_numbers(coder.decimal(t or "")).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["id", "ids"])

    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """Columns id and text."""
    plain = rows.select(rows[id_col].alias("id"), rows[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path)
        for b in batches:
            texts = [coder.decode(np.array(ids or [], np.int64))[0].decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass and keeps digests: id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas) and decoded_sha256 (of the decoded text)."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path)

        def part(rows: list[str], out: list[list]) -> None:
            ids = _numbers(",".join(filter(None, rows)))
            raw, begins = coder.decode(ids)
            at = 0
            for row in rows:
                n = row.count(",") + 1 if row else 0
                text = raw[begins[at]:begins[at + n]].decode("utf-8", "replace")
                at += n
                for column, cell in zip(out, (n, hashlib.sha256(row.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())):
                    column.append(cell)

        for b in batches:
            out: list[list] = [[], [], []]
            rows, held = [], 0
            for t in b.column(1).to_pylist():
                rows.append(coder.decimal(t or ""))
                held += len(rows[-1])
                if held > PART_BYTES:
                    part(rows, out)
                    rows, held = [], 0
            part(rows, out)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                                             names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
