"""Byte-level BPE encoding and decoding with a rank file.

Two tiers: a minimal perfect hash finds pre-tokens that are whole entries of the
vocabulary; any other pre-token is merged pair by pair, lowest rank and then leftmost
first, with a heap over linked pieces. Pieces of text that occur again within a task are
looked up, up to a fixed number of them.

Defined cases: a null text encodes as empty, and an empty text has no ids; no string is a
special token; lone surrogates cannot occur in Spark strings; one very long pre-token
takes time n log n.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame

from kerbside.llm.texts import keyed, map_blocks, tables_of

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: White space as the pattern's authors' engine has it: the Unicode property, without the file separators.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space beside a space, and the white space beyond ASCII: texts with either are cut with more care.
BESIDE = [pair for c in "\t\n\v\f\r" for pair in (c + " ", " " + c)] + ["  "]
RARE_SPACE = [c for c in map(chr, range(128, 0x3001)) if regex.match(f"[{SPACE}]", c)]
#: Character below which what counts as a letter is the same in any version of Unicode.
BEYOND_LATIN = "\u0250"
#: Entries of the per-task tables of text pieces (about 250 MB) and of pre-tokens, and characters up to which one enters.
PIECES, TOKENS, PIECE_CHARS = 1_000_000, 400_000, 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: as many slots as keys, one probe a lookup."""

    def __init__(self, keys: list[bytes]):
        self.size, self.buckets = len(keys), max(1, len(keys) // 3)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            members.setdefault(h % self.buckets, []).append(i)
        self.shift = [0] * self.buckets  # below zero: the only key's slot, as -1 - slot
        self.slots = [-1] * self.size
        free = set(range(self.size))
        for bucket, group in sorted(members.items(), key=lambda m: (-len(m[1]), m[0])):
            if len(group) == 1:
                slot = free.pop()
                self.slots[slot], self.shift[bucket] = group[0], -1 - slot
                continue
            shift = 0
            while True:
                spots = [self._slot(hashes[i], shift) for i in group]
                if len(set(spots)) == len(spots) and free.issuperset(spots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for i, spot in zip(group, spots, strict=True):
                self.slots[spot] = i
                free.remove(spot)

    def _slot(self, h: int, shift: int) -> int:
        h = (h ^ (shift + 1) * 0x9E3779B97F4A7C15) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (h >> 24) % self.size

    def slot(self, key: bytes) -> int:
        """The only slot where ``key`` can be; what is stored there must be compared."""
        if not self.size:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        return -1 - shift if shift < 0 else self._slot(h, shift)


class Vocabulary:
    """Token bytes and their ranks behind the perfect hash."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = list(ranks)
        self.hash = PerfectHash(tokens)
        self.keys = [tokens[i] for i in self.hash.slots]
        self.ranks = [ranks[k] for k in self.keys]
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = [self.rank(bytes([b])) for b in range(256)]
        # By a token's rank: the tokens that join with it from behind, and the rank of both. The last row is of no token.
        none: dict[int, int] = {}
        self.joins = [none] * (len(self.bytes_of) + 1)
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    if self.joins[left] is none:
                        self.joins[left] = {}
                    self.joins[left][right] = rank

    def rank(self, token: bytes) -> int | None:
        slot = self.hash.slot(token)
        return self.ranks[slot] if slot >= 0 and self.keys[slot] == token else None

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.rank(piece)
        return [whole] if whole is not None else self.merged(piece)

    def merged(self, piece: bytes) -> list[int]:
        n, joins, push = len(piece), self.joins, heapq.heappush
        # Place n stands behind the last piece and, as -1, before the first one; it joins with nothing.
        ids = [*map(self.byte_ids.__getitem__, piece), -1]
        after, before = list(range(1, n + 2)), list(range(-1, n))
        # Heap entries are a rank and, in the low bits, a place, so equal ranks merge leftmost first.
        bits = n.bit_length()
        low = (1 << bits) - 1
        # Entry of each piece with the one after it now, -1 for none.
        joined = [
            -1 if (rank := joins[left].get(right)) is None else rank << bits | place
            for place, (left, right) in enumerate(pairwise(ids))
        ]
        heap = [entry for entry in joined if entry >= 0]
        heapq.heapify(heap)
        joined.append(-1)
        while heap:
            entry = heapq.heappop(heap)
            left = entry & low
            if joined[left] != entry:
                continue  # one of the two has been merged otherwise since
            rank, right, ahead = entry >> bits, after[left], before[left]
            beyond = after[right]
            ids[left], ids[right], joined[right] = rank, -1, -1
            after[left], before[beyond] = beyond, left
            new = joins[rank].get(ids[beyond])
            if new is None:
                joined[left] = -1
            else:
                joined[left] = new = new << bits | left
                push(heap, new)
            new = joins[ids[ahead]].get(rank)
            if new is None:
                joined[ahead] = -1
            else:
                joined[ahead] = new = new << bits | ahead
                push(heap, new)
        return [i for i in ids if i >= 0]


class Encoder:
    """Splits texts by the pattern and encodes them; keeps the ids of short pieces seen before."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        spelled = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
        self.vocabulary, self.pretokens = vocabulary, regex.compile(spelled).findall
        # A space between two other characters always begins a pre-token, whatever is around it.
        self.cut = regex.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])").split
        self.letters = pattern == public_tokenizers.PATTERN  # it takes a space and the letters after it as one pre-token
        self.known: dict[str, tuple[int, ...]] = {}
        self.tokens: dict[str, tuple[int, ...]] = {}

    def _token(self, token: str) -> tuple[int, ...]:
        """Ids of a pre-token; with the space before it, it is a piece of text by itself."""
        got = self.known.get(token[1:]) if token[0] == " " else self.tokens.get(token)
        if got is None:
            got = tuple(self.vocabulary.encode_piece(token.encode("utf-8", "surrogatepass")))
            if len(token) <= PIECE_CHARS:
                table, name, most = (self.known, token[1:], PIECES) if token[0] == " " else (self.tokens, token, TOKENS)
                if len(table) >= most:
                    table.clear()
                table[name] = got
        return got

    def _piece(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self._token, self.pretokens(text))))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        plain = text[0] != " " and text[-1] != " " and not any(map(text.__contains__, BESIDE)) and (
            text.isascii() or not any(map(text.__contains__, RARE_SPACE))
        )
        first, *rest = text.split(" ") if plain else self.cut(text)
        known = self.known
        out = list(map(known.get, rest))
        for at, ids in enumerate(out):
            if ids is None:
                part = rest[at]
                ids = known.get(part)  # since the text began
                if ids is None and self.letters and part.isalpha() and (part.isascii() or max(part) < BEYOND_LATIN):
                    ids = self._token(" " + part)
                elif ids is None:
                    ids = self._piece(" " + part)
                    if len(part) <= PIECE_CHARS:
                        if len(known) >= PIECES:
                            known.clear()
                        known[part] = ids
                out[at] = ids
        return [*self._piece(first), *chain.from_iterable(out)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def encoder(path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """One encoder a process, while it works for this operator; the rank file is installed on every machine and at most a few MB."""
    encoders = tables_of(__name__)
    if (path, pattern) not in encoders:
        encoders[path, pattern] = Encoder(Vocabulary(read_ranks(path)), pattern)
    return encoders[path, pattern]


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Per row: key, ``ids``, and whether they decode to the text again."""

    def work(block):
        own, out = encoder(path, pattern), {"ids": [], "same": []}
        for t in block[1]:
            ids = own.encode(t)
            out["ids"].append(np.asarray(ids, np.int32))
            out["same"].append(own.decode(ids) == t.encode("utf-8", "surrogatepass"))
        return out

    return map_blocks(keyed(docs, key, text), work, "ids array<int>, same boolean").withColumnRenamed("key", key)


def decode(
    encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Per row: key and the ``decoded`` bytes; null ids decode as none."""

    def run(batches):
        import pyarrow as pa

        own = encoder(path, pattern)
        for batch in batches:
            out = [own.decode(row.as_py() or []) for row in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "decoded"])

    kind = dict(encoded.dtypes)[key]
    return encoded.selectExpr(f"`{key}` AS key", f"`{ids}` AS ids").mapInArrow(
        run, f"key {kind}, decoded binary"
    ).withColumnRenamed("key", key)


def round_trip(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Per row: key, number of ids, digests of the ids and of the bytes they decode to, and whether these are the text."""

    def work(block):
        own = encoder(path, pattern)
        names = [str(i) for i in range(len(own.vocabulary.bytes_of))]
        out = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "same": []}
        for t in block[1]:
            ids = own.encode(t)
            back = own.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
            out["same"].append(back == t.encode("utf-8", "surrogatepass"))
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"
    return map_blocks(keyed(docs, key, text), work, schema).withColumnRenamed("key", key)


def digest(docs: DataFrame) -> DataFrame:
    return round_trip(docs)
