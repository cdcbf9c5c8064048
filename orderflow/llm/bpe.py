"""Operator 2: BPE encoding and decoding with forced-boundary splitting.

A merge only ever builds a token of the vocabulary. So where two neighbouring bytes occur side by side inside no token,
no token can span them, and the cut between them is certain: what stands on either side is merged independently. The
encoder takes the byte pairs that no token holds from the vocabulary, cuts each pre-token there, merges each fragment by
itself and concatenates the ids. Fragments are independent, so those of a whole batch are merged in the same numpy
rounds; pre-tokens recur, so their ids are kept in a bounded memo.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from orderflow.llm.common import by_row

#: Fixed value: the pattern that splits text before the merges (white space by its Unicode property).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
                        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pre-tokens that a worker remembers (some 200 bytes each); a full memo is begun anew with the next batch.
MEMO = 500_000
#: Longer pre-tokens are merged by a heap.
LONG_BYTES = 200
_NO_RANK = 1 << 40
_WIDTH = 1 << 20  # above any id


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one character: printable Latin-1 as itself, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    """Encoder and decoder for a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = {t: bytes(alphabet[c] for c in t) for t in spec["model"]["vocab"]}
        self.bytes_of: dict[int, bytes] = {i: raw[t] for t, i in spec["model"]["vocab"].items()}
        id_of = {b: i for i, b in self.bytes_of.items()}
        self.byte_ids = np.array([id_of[bytes([b])] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        pairs = [(id_of[raw[a]], id_of[raw[b]], id_of[raw[a + b]]) for a, b in merges]
        #: (left id, right id) -> (rank, merged id), and the same as sorted keys with ranks
        self.merges = {(a, b): (rank, new) for rank, (a, b, new) in enumerate(pairs)}
        keys = np.array([a * _WIDTH + b for a, b, _ in pairs], np.int64)
        self.pair_ranks = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.pair_ranks]
        self.merged = np.array([new for _, _, new in pairs], np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.inside = np.zeros((256, 256), bool)  # byte pairs that occur within a token
        for token in raw.values():
            self.inside[list(token[:-1]), list(token[1:])] = True
        self.fixed = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        self.memo: dict[str | int, bytes] = dict(self.fixed)

    def cuts(self, raw: np.ndarray) -> list[int]:
        """Where bytes are certain to be cut: between two that stand side by side in no token."""
        return (np.flatnonzero(~self.inside[raw[:-1], raw[1:]]) + 1).tolist()

    def _merge_all(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges fragments that lie one after another, each by itself but all in the same rounds.

        ``starts``: where each fragment begins. In a round each fragment merges its pair of lowest rank, everywhere.
        Returns the ids that are left, and of which input position each is the first.
        """
        at = np.arange(len(ids))
        fragment = np.zeros(len(ids), np.int64)
        fragment[starts[1:]] = 1
        fragment = np.cumsum(fragment)
        rank = self._ranks(ids, fragment, at)
        done_ids, done_at = [], []
        while len(ids):
            first = np.flatnonzero(np.diff(fragment, prepend=-1))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(ids))
            low = np.repeat(low, size)
            going = low < _NO_RANK
            if not going.all():
                done_ids.append(ids[~going])
                done_at.append(at[~going])
                ids, at, fragment, rank, low = ids[going], at[going], fragment[going], rank[going], low[going]
                if not len(ids):
                    break
            hit = rank == low
            # of a run of equal ids every second pair is merged, from the left
            run = np.flatnonzero(hit)
            new_run = np.diff(run, prepend=-2) != 1
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(run)), 0))
            left = run[(np.arange(len(run)) - begin) % 2 == 0]
            ids[left] = self.merged[rank[left]]
            keep = np.ones(len(ids), bool)
            keep[left + 1] = False
            moved = np.cumsum(keep) - 1
            ids, at, fragment, rank = ids[keep], at[keep], fragment[keep], rank[keep]
            touched = np.zeros(len(ids), bool)
            touched[moved[left]] = touched[np.maximum(moved[left] - 1, 0)] = True
            changed = np.flatnonzero(touched)
            rank[changed] = self._ranks(ids, fragment, changed)
        done_ids, done_at = np.concatenate(done_ids), np.concatenate(done_at)
        order = np.argsort(done_at)
        return done_ids[order], done_at[order]

    def _ranks(self, ids: np.ndarray, fragment: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position of ``at``; none across fragments."""
        after = np.minimum(at + 1, len(ids) - 1)
        key = ids[at] * _WIDTH + ids[after]
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        ok = (self.pair_keys[i] == key) & (fragment[at] == fragment[after]) & (after > at)
        return np.where(ok, self.pair_ranks[i], _NO_RANK)

    def _merge_long(self, fragment: bytes) -> list[int]:
        """The same for one long fragment, with a heap over a linked list: n log n steps."""
        ids = self.byte_ids[np.frombuffer(fragment, np.uint8)].tolist()
        n, get = len(ids), self.merges.get
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [x for x in ids if x >= 0]

    def _learn(self, pieces: list[str]) -> None:
        """Encodes pre-tokens that the memo hasn't: all their fragments are merged together."""
        raws = [p.encode("utf-8", "surrogatepass") for p in pieces]
        short = [i for i, r in enumerate(raws) if len(r) <= LONG_BYTES]
        if short:
            raw = np.frombuffer(b"".join(raws[i] for i in short), np.uint8)
            ends = np.cumsum([len(raws[i]) for i in short])
            starts = np.union1d(np.concatenate(([0], ends[:-1])), np.array(self.cuts(raw), np.int64))
            ids, at = self._merge_all(self.byte_ids[raw], starts)
            of = np.searchsorted(at, np.concatenate(([0], ends)))
            packed = ids.astype("<u4").tobytes()
            for i, a, b in zip(short, of[:-1].tolist(), of[1:].tolist(), strict=True):
                self.memo[pieces[i]] = packed[4 * a:4 * b]
        for piece, raw in zip(pieces, raws, strict=True):
            if len(raw) > LONG_BYTES:
                marks = [0, *self.cuts(np.frombuffer(raw, np.uint8)), len(raw)]
                ids = [x for a, b in zip(marks, marks[1:], strict=False) for x in self._merge_long(raw[a:b])]
                self.memo[piece] = np.array(ids, "<u4").tobytes()

    def _pieces(self, text: str) -> list:
        """Pre-tokens in order; a special token's string in the text is that token, as its id."""
        if not self.special_pattern or not self.special_pattern.search(text):
            return PATTERN.findall(text)
        parts, at = [], 0
        for m in self.special_pattern.finditer(text):
            parts += [*PATTERN.findall(text[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return parts + PATTERN.findall(text[at:])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo = dict(self.fixed)
        pieces = [self._pieces(t) for t in texts]
        if new := list(set().union(*pieces).difference(self.memo)):
            self._learn(new)
        return [b"".join(map(self.memo.__getitem__, p)) for p in pieces]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, packed: bytes) -> str:
        """The text of ids; bytes that aren't UTF-8 become the replacement character."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(1)
def encoder(path: str) -> ForcedBoundaryBPE:
    """One encoder for each Python worker."""
    return ForcedBoundaryBPE(path)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: id, ids (array of int).

    A null or empty text has no ids. Repeated rows are encoded each; an empty table gives no rows; other columns are
    left out, whatever their names. ``vocabulary`` must be readable at the same path on every executor.
    """
    path = vocabulary or default_vocabulary()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "ids": [
                np.frombuffer(p, "<i4") for p in encoder(path).encode_batch([t or "" for t in batch["text"]])]})

    return by_row(docs, encode, id_col, "ids array<int>", text=text_col)


def decode_documents(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """One row for each row of ``encoded``: id, text. Null ids are an empty text."""
    path = vocabulary or default_vocabulary()

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "text": [
                "" if ids is None else encoder(path).decode(np.asarray(ids, "<u4").tobytes()) for ids in batch["ids"]]})

    return by_row(encoded, decode, id_col, "text string", ids=ids_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Encoded and decoded in one pass; one row for each row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256.

    The cases of ``encode_documents`` hold.
    """
    path = vocabulary or default_vocabulary()

    def both(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for batch in batches:
            packed = bpe.encode_batch([t or "" for t in batch["text"]])
            yield pd.DataFrame({
                "id": batch["id"], "n_tokens": [len(p) // 4 for p in packed],
                "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
                "decoded_sha256": [hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed]})

    return by_row(docs, both, id_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", text=text_col)
