"""Byte-level BPE by backtracking over an Aho-Corasick automaton.

Bytes become the Latin-1 characters of the same numbers, so pyahocorasick can
hold the vocabulary. A piece is encoded from left to right: take the longest
token at the place, and shorter ones after it, until one is compatible with
the token before. Two adjacent tokens are compatible if the merges that made
them would not have merged across their seam; the answer is memoised. A place
from which nothing fits is marked dead and never visited again, so the time is
linear in the piece. The result is exactly that of applying merges by rank.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proclivity.llm.chunks import LONGEST_KEPT, Memo
from proclivity.llm.common import map_batches, schema

SCHEMA = schema(
    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
)


class ByteBPE:
    """Encoder and decoder for a rank file (`base64-token rank` lines)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must be 0, 1, 2, ... without a gap")
        if any(ranks.get(bytes([i]), 256) > 255 for i in range(256)):
            raise ValueError("the 256 bytes must have the lowest ranks")
        self.pattern = regex.compile(pattern)
        self.bytes_of = sorted(ranks, key=ranks.__getitem__)
        self.text_of = [t.decode("latin-1") for t in self.bytes_of]
        self.rank_of = {t: i for i, t in enumerate(self.text_of)}
        self.size_of = [len(t) for t in self.text_of]
        self.seams: dict[tuple[int, int], bool] = {}
        self.parts: list[tuple[int, int] | None] = [None] * len(ranks)
        for token, text in enumerate(self.text_of):
            if len(text) > 1:
                self.parts[token] = self._last_merge(token, text)
        # a token that no merges lead to is never chosen inside a piece
        made = [
            len(t) == 1 or p is not None
            for t, p in zip(self.text_of, self.parts, strict=True)
        ]
        self.shorter = [self._prefix(t, made) for t in self.text_of]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, text in enumerate(self.text_of):
            if made[token]:
                self.automaton.add_word(text, token)
        self.automaton.make_automaton()
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.shared = list(range(len(ranks)))  # memos hold these objects
        self.memo = Memo(lambda parts: map(self._encode_pieces, parts))
        self.decimals = [str(i) for i in range(len(ranks))]

    def _prefix(self, text: str, made: list[bool]) -> int:
        for n in range(len(text) - 1, 0, -1):
            token = self.rank_of.get(text[:n], -1)
            if token >= 0 and made[token]:
                return token
        return -1

    def _last_merge(self, token: int, text: str) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one."""
        for n in range(len(text) - 1, 0, -1):
            a = self.rank_of.get(text[:n], token)
            b = self.rank_of.get(text[n:], token)
            if (
                a < token
                and b < token
                and all(self.size_of[x] == 1 or self.parts[x] for x in (a, b))
                and self._holds(a, b, token)
            ):
                return a, b
        return None

    def _holds(self, a: int, b: int, limit: int) -> bool:
        """False if a merge of a rank below the limit crosses the seam.

        The younger of the two tokens is opened again and again. Before it
        was made its inner part stood at the seam, and a merge across would
        have come first if its rank is lower, or equal and further left.
        """
        rank_of, text_of, parts = self.rank_of, self.text_of, self.parts
        while True:
            if rank_of.get(text_of[a] + text_of[b], limit) < limit:
                return False
            if a > b:
                if parts[a] is None:
                    return True
                limit, a = a, parts[a][1]
            else:
                if parts[b] is None:
                    return True
                limit, b = b + 1, parts[b][0]

    def compatible(self, a: int, b: int) -> bool:
        known = self.seams.get((a, b))
        if known is None:
            if len(self.seams) > 500_000:
                self.seams.clear()
            known = self._holds(a, b, len(self.text_of))
            self.seams[a, b] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """Tokens of one match of the pattern, given as Latin-1."""
        whole = self.rank_of.get(piece)
        if whole is not None:
            return [whole]
        size_of, shorter, seams = self.size_of, self.shorter, self.seams
        n = len(piece)
        longest = [-1] * (n + 1)
        for end, token in self.automaton.iter(piece):
            # ends come in ascending order, so the last one is the longest
            longest[end + 1 - size_of[token]] = token
        dead = bytearray(n + 1)
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                if not dead[at + size_of[token]]:
                    fits = last < 0 or seams.get((last, token))
                    if fits is None:
                        fits = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size_of[token]
                last, token = token, longest[at]
            else:
                dead[at] = 1
                token = out.pop()
                at -= size_of[token]
                last, token = out[-1] if out else -1, shorter[token]
        return out

    def _encode_pieces(self, text: str) -> tuple[int, ...]:
        out: list[int] = []
        pieces = self.pieces
        for piece in self.pattern.findall(text):
            ids = pieces.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode().decode("latin-1"))
                ids = tuple(map(self.shared.__getitem__, ids))
                if len(piece) <= LONGEST_KEPT:
                    if len(pieces) > 300_000:
                        pieces.clear()
                    pieces[piece] = ids
            out += ids
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for ids in self.memo.of(text):
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    """The encoder of a rank file, built once in each Python worker."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return ByteBPE({base64.b64decode(a): int(b) for a, b in pairs}, pattern)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode and decode every text.

    One row per row of `docs`: doc_id, n_tokens, ids_sha256 (of the decimal
    ids joined by one space), decoded_sha256. Null and empty texts have no
    tokens and the digests of nothing; a null doc_id stays null; repeated rows
    stay; other columns are ignored. `path` names the rank file on each
    executor.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        bpe = load(path, pattern)
        out: dict[str, list] = {
            "doc_id": cols["doc_id"],
            "n_tokens": [],
            "ids_sha256": [],
            "decoded_sha256": [],
        }
        for text in cols["text"]:
            ids = bpe.encode(text or "")
            decimals = " ".join(map(bpe.decimals.__getitem__, ids))
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(
                hashlib.sha256(decimals.encode()).hexdigest()
            )
            out["decoded_sha256"].append(
                hashlib.sha256(bpe.decode(ids)).hexdigest()
            )
        return out

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return map_batches(rows, run, SCHEMA)
