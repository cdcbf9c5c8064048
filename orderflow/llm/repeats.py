"""Operator 3: suffix-array dedup of repeated byte strings by common-prefix interval trees.

A byte goes if a string of ``window`` bytes that covers it also starts earlier (in a document of a smaller id, or earlier in
the same one). That is the union, over all maximal repeats of at least ``window`` bytes, of their occurrences but the first.

An enhanced suffix array of everything would hold every position of the corpus. Here it is sparse: of each window the
position with the least hash of its next ``K`` bytes is an anchor, and since that depends on the window's bytes alone,
all occurrences of a window have their anchor at the same place. The steps:

1. Every anchor sends a hash of its ``K`` bytes (the key), a hash of its context (all windows around it), and its place.
   Of equal key and context all but the first are repeats as a whole; a task settles its own before the shuffle.
2. Only keys that are left with several contexts need text: the first place of each context sends its bytes.
3. For each such key the suffixes at its anchors are sorted, their common prefixes are scanned with a stack, and every
   interval is a repeat to the right with all its occurrences. Its left contexts are tested: where they are all alike,
   all occurrences extend to the left alike, else a scan of them in order gives each occurrence the longest extension
   that it shares with an earlier one. Repeats of ``window`` bytes and more are spans to remove.

A key that is frequent would gather in one task. Frequent keys are counted over all documents; an anchor with one is
replaced by longer cores within its windows, with a key each, in up to three steps; the last are whole windows, for
which no context is left. Which keys count as frequent changes the work, never the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import mix64, packed, unpack
#: At most so many frequent keys are told to all tasks.
FREQUENT_KEPT = 100_000
#: Bytes that are hashed together.
CHUNK_BYTES = 1 << 19

_BASE = 0x5851F42D4C957F2D
_BYTE = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x2545F4914F6CDD1D)) | np.uint64(1)
_SALT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_END = 1 << 62


@dataclass(frozen=True)
class Settings:
    """``cores``: bytes of an anchor's key, and of the longer cores that take the place of frequent ones.

    A key is counted as frequent if it has this share of contexts by documents in a part of a task, and so many at least.
    """

    window: int = 100
    cores: tuple[int, ...] = (32, 83, 96, 100)
    frequent_share: float = 0.01
    frequent_least: int = 16


_BYTE = mix64(_BYTE)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse, up to ``n``."""
    if len(_POWERS[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(n + n // 4 + 1, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.cumprod(row)
    return _POWERS


def _slide(a: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (a minimum or maximum) of every run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        a = best(a[:-size], a[size:])
        size *= 2
    rest = width - size
    return best(a[:-rest], a[rest:]) if rest else a


class Chunk:
    """Documents one after another, with hashes of any of their substrings."""

    def __init__(self, texts: list[bytes], ids: list[int], settings: Settings):
        self.settings, self.ids = settings, np.array(ids, np.int64)
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.end_at = np.repeat(self.ends, sizes)
        n = len(self.buffer)
        up, self.down = (p[:n + 1] for p in _powers(n))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[self.buffer] * up[:n])))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def anchors(self) -> np.ndarray:
        """Of every window the place of its least key (all places if it recurs)."""
        w, k, n = self.settings.window, self.settings.cores[0], len(self.buffer)
        if n < w:
            return np.zeros(0, np.int64)
        h = mix64((self.sums[k:] - self.sums[:n - k + 1]) * self.down[:n - k + 1])
        h = np.clip((h >> np.uint64(32)).astype(np.uint32), 1, 0xFFFFFFFE)
        h[np.arange(k, n + 1) > self.end_at[:n - k + 1]] = 0xFFFFFFFF  # across documents
        least = _slide(h, w - k + 1, np.minimum)
        least[np.arange(w, n + 1) > self.end_at[:n - w + 1]] = 0
        pad = np.zeros(w - k, np.uint32)
        greatest = _slide(np.concatenate((pad, least, pad)), w - k + 1, np.maximum)
        return np.flatnonzero((h == greatest) & (greatest > 0))

    def rows(self, at: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and context hashes of cores at these places."""
        w, k = self.settings.window, self.settings.cores[level]
        doc = np.searchsorted(self.ends, at, side="right")
        left, right = np.maximum(at - (w - k), self.starts[doc]), np.minimum(at + w, self.ends[doc])
        context = self.hash(left, right) + (at - left).astype(np.uint64) * _SALT[0] + (right - at).astype(np.uint64) * _SALT[1]
        return (self.hash(at, at + k) ^ _SALT[level]).view(np.int64), mix64(context).view(np.int64)

    def longer(self, at: np.ndarray, level: int) -> np.ndarray:
        """Cores of the next level: each window of the given cores holds one, placed alike wherever the window occurs."""
        w, k, longer = self.settings.window, self.settings.cores[level], self.settings.cores[level + 1]
        doc = np.searchsorted(self.ends, at, side="right")
        lots = []
        for first in range(0, w - k + 1, w - longer + 1):
            low = at - (w - k) + first
            high = np.minimum(low + (w - longer), at)
            some = np.maximum(low, self.starts[doc]) <= np.minimum(high, self.ends[doc] - w)
            lots.append(high[some])
        return np.unique(np.concatenate(lots))


    def runs(self, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans of documents, cut to these, as maximal runs: document, start and end."""
        start, end = np.maximum(start, self.starts[doc]), np.minimum(end, self.ends[doc])
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], np.maximum.accumulate(end[order])
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc))[: len(first)] - 1
        return doc[first], start[first], end[last]


def _chunks(batches: Iterator[pd.DataFrame], settings: Settings, marked: list | None = None) -> Iterator[Chunk]:
    """Chunks of a task's documents without copies; a copy of a greater id is added to ``marked`` as a whole."""
    first: dict[bytes, int] = {}
    texts, ids, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch["id"].tolist(), batch["text"], strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            if len(raw) < settings.window:
                continue
            digest = hashlib.blake2b(raw, digest_size=16).digest()
            before = first.get(digest)
            if before is not None and before <= i:
                if before < i and marked is not None:
                    marked.append(i)
                continue
            first[digest] = i
            texts.append(raw)
            ids.append(i)
            size += len(raw)
            if size >= CHUNK_BYTES:
                yield Chunk(texts, ids, settings)
                texts, ids, size = [], [], 0
    yield Chunk(texts, ids, settings)


def _fresh(key: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Which rows of a sorted list differ from the one before."""
    first = np.ones(len(key), bool)
    first[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
    return first


def frequent_keys(docs: DataFrame, settings: Settings) -> list[np.ndarray]:
    """Sorted frequent keys by level; at most ``FREQUENT_KEPT`` in all, those with most contexts."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = []
        n = 0

        def often() -> pd.DataFrame:
            found = []
            for level, rows in enumerate(held):
                key, context = (np.concatenate(x) for x in zip(*rows, strict=True))
                order = np.lexsort((context, key))
                key, context = key[order], context[order]
                value, times = np.unique(key[_fresh(key, context)], return_counts=True)
                some = times >= max(settings.frequent_least, settings.frequent_share * n)
                found.append(pd.DataFrame({"level": level, "key": value[some], "n": times[some]}))
            return pd.concat(found)

        for chunk in _chunks(batches, settings):
            at, n = chunk.anchors(), n + len(chunk.ids)
            for level in range(len(settings.cores) - 1):
                if level == len(held):
                    held.append([])
                rows = chunk.rows(at, level)
                held[level].append(rows)
                value, times = np.unique(rows[0], return_counts=True)  # longer cores only where a key recurs here
                at = at[np.isin(rows[0], value[times >= 3])]
                at = chunk.longer(at, level) if len(at) else at
            if sum(len(k) for k, _ in held[0]) > 200_000:
                yield often()
                held, n = [], 0
        if held:
            yield often()

    rows = docs.mapInPandas(count, "level int, key long, n long").groupBy("level", "key").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "level", "key").limit(FREQUENT_KEPT).collect()
    return [np.sort(np.array([r["key"] for r in rows if r["level"] == k], np.int64)) for k in range(len(settings.cores) - 1)]


def _is_in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


#: Of an anchor: key, context and place (by 4, plus level). Of a span that is settled: ``at`` is minus its start, less 1, and
#: ``context`` its end; the key is any.
_ROWS = "key long, context long, id long, at long"


def _settled(key: np.ndarray, context: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in order of key, context and place, equal ones once; and which of them is the first of its key and context."""
    order = np.lexsort((at, ids, context, key))
    order = order[_fresh(key[order], context[order]) | _fresh(ids[order], at[order])]  # a document that recurs is one
    return order, _fresh(key[order], context[order])


def _anchor_rows(settings: Settings, shared):
    """Rows of anchors, and of spans that a chunk settles itself."""
    def copied(copies: list[int]) -> pd.DataFrame:
        ids = np.array(copies, np.int64)
        copies.clear()
        return pd.DataFrame({"key": mix64(ids.view(np.uint64)).view(np.int64), "context": _END, "id": ids, "at": np.int64(-1)})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        copies: list[int] = []
        for chunk in _chunks(batches, settings, copies):
            at, found = chunk.anchors(), []
            for level in range(len(settings.cores)):
                if not len(at):
                    break
                key, context = chunk.rows(at, level)
                often = _is_in(key, shared.value[level]) if level < len(settings.cores) - 1 else np.zeros(len(at), bool)
                found.append((key[~often], context[~often], at[~often], np.full((~often).sum(), level)))
                at = chunk.longer(at[often], level) if often.any() else at[:0]
            if found:
                key, context, at, level = (np.concatenate(x) for x in zip(*found, strict=True))
                doc = np.searchsorted(chunk.ends, at, side="right")
                ids, place = chunk.ids[doc], (at - chunk.starts[doc]) * 4 + level
                order, first = _settled(key, context, ids, place)
                keep = order[first]
                yield pd.DataFrame({"key": key[keep], "context": context[keep], "id": ids[keep], "at": place[keep]})
                again = order[~first]
                core = np.array(settings.cores)[level[again]]
                doc, start, end = chunk.runs(doc[again], at[again] - settings.window + core, at[again] + settings.window)
                yield pd.DataFrame({"key": mix64((start + doc * 31).view(np.uint64)).view(np.int64), "context": end - chunk.starts[doc],
                                    "id": chunk.ids[doc], "at": chunk.starts[doc] - start - 1})
            if copies:
                yield copied(copies)
        if copies:
            yield copied(copies)
    return read


def _resolve(settings: Settings):
    return lambda batches: _resolved(batches, settings)


def _resolved(batches: Iterator[pd.DataFrame], settings: Settings) -> Iterator[pd.DataFrame]:
    """Per partition: settled spans (``at`` negative, ``to``: end), and the first places of keys with several contexts (``to``: key)."""
    held = [tuple(b[c].to_numpy() for c in ("key", "context", "id", "at")) for b in batches]
    if not held:
        return
    key, context, ids, at = (np.concatenate(x) for x in zip(*held, strict=True))
    done = at < 0
    yield pd.DataFrame({"id": ids[done], "at": at[done], "to": context[done]})
    key, context, ids, at = (x[~done] for x in (key, context, ids, at))
    order, first = _settled(key, context, ids, at)
    again = order[~first]
    place, core = at[again] // 4, np.array(settings.cores)[at[again] % 4]
    yield pd.DataFrame({"id": ids[again], "at": -np.maximum(0, place - settings.window + core) - 1, "to": place + settings.window})
    order = order[first]
    same = key[order[1:]] == key[order[:-1]]
    several = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(order) else np.zeros(0, bool)
    yield pd.DataFrame({"id": ids[order[several]], "at": at[order[several]], "to": key[order[several]]})


def _common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before it."""
    differs = rows[1:] != rows[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))


def _matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings])
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width), sizes


def _intervals(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The tree of common-prefix intervals, (length, first, last) from the leaves up, by a stack scan."""
    stack = [(0, 0)]
    values = [*common.tolist(), -1]
    for i, value in enumerate(values, 1):
        begin = i - 1
        while stack and value < stack[-1][0]:
            length, begin = stack.pop()
            yield length, begin, i - 1
        if value >= 0 and (not stack or value > stack[-1][0]):
            stack.append((value, begin))


def _with_earlier(places: list[int], common: list[int]) -> list[int]:
    """For each string of a sorted list the longest prefix it shares with one of an earlier place (-1: there is none).

    Those of equal places aren't earlier than each other.
    """
    best = [-1] * len(places)
    for forward in (True, False):
        stack: list[tuple[int, int]] = []
        for i in range(len(places)) if forward else range(len(places) - 1, -1, -1):
            shared = (common[i - 1] if i else 0) if forward else (common[i] if i < len(common) else 0)
            while stack and stack[-1][0] >= places[i]:
                shared = min(shared, stack.pop()[1])
            if stack:
                best[i] = max(best[i], shared)
            stack.append((places[i], shared))
    return best


def key_spans(lefts: list[bytes], rights: list[bytes], window: int, ranks: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(occurrence, bytes to the left, bytes to the right) of repeats of ``window`` bytes and more.

    Occurrences are in order of place; ``ranks``: equal for equal places, if there are any. ``rights``: the suffixes at the anchors; ``lefts``: what precedes, reversed.
    """
    ranks = range(len(rights)) if ranks is None else ranks
    r, r_size = _matrix(rights, window)
    by_right = np.array(sorted(range(len(rights)), key=rights.__getitem__))
    l, l_size = _matrix(lefts, max(1, max(map(len, lefts))))
    left_rank = np.empty(len(lefts), np.int64)
    left_rank[sorted(range(len(lefts)), key=lefts.__getitem__)] = np.arange(len(lefts))
    found = []
    for length, begin, last in _intervals(_common(r[by_right], r_size[by_right])):
        if length + l.shape[1] < window or not length:
            continue
        held = by_right[begin:last + 1]
        held = held[np.argsort(left_rank[held])]
        common = _common(l[held], l_size[held])
        if length + common.max() < window:
            continue
        places = held.tolist()
        if (common == l_size[held[1:]]).all() and (common == l_size[held[:-1]]).all():
            # no diversity to the left: all but the first occurrence extend alike
            found += [(p, int(common[0]), length) for p in places if ranks[p] != ranks[min(places)]]
            continue
        best = _with_earlier([ranks[p] for p in places], common.tolist())
        found += [(p, b, length) for p, b in zip(places, best, strict=True) if b >= 0 and b + length >= window]
    return found


def _tree_spans(settings: Settings):
    """Per partition: spans to remove, from contexts with equal keys."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        rows = pd.concat(held).sort_values(["key", "id", "at"], ignore_index=True)
        key, ids, left = rows["key"].to_numpy(), rows["id"].to_numpy(), rows["left"].to_numpy()
        place, text = rows["at"].to_numpy() // 4, rows["bytes"].tolist()
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = np.append(starts[1:], len(key))
        out = []
        pairs = starts[ends - starts == 2]
        for at in range(0, len(pairs), 4096):  # two occurrences: a tree of one interval
            one = pairs[at:at + 4096]
            both = np.concatenate((one, one + 1))
            r, r_size = _matrix([text[i][left[i]:] for i in both], settings.window)
            l, l_size = _matrix([text[i][:left[i]][::-1] for i in both], settings.window)
            n = len(one)
            span = [_common(np.stack((x[:n], x[n:]), 1).reshape(2 * n, -1), np.stack((s[:n], s[n:]), 1).ravel())[::2]
                    for x, s in ((l, l_size), (r, r_size))]
            apart = (ids[one] != ids[one + 1]) | (place[one] != place[one + 1])
            good = apart & (span[0] + span[1] >= settings.window)
            later = one[good] + 1
            out.append((ids[later], place[later] - span[0][good], place[later] + span[1][good]))
        for a, b in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
            ranks = np.cumsum(_fresh(ids[a:b], place[a:b])).tolist()
            spans = key_spans([text[i][:left[i]][::-1] for i in range(a, b)], [text[i][left[i]:] for i in range(a, b)], settings.window, ranks)
            if spans:
                i, before, after = (np.array(x) for x in zip(*spans, strict=True))
                out.append((ids[a + i], place[a + i] - before, place[a + i] + after))
        if out:
            i, s, e = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pd.DataFrame({"id": i, "start": s, "end": e}).drop_duplicates()
    return scan


def _contexts(settings: Settings):
    """The bytes around each place that needs text."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text, places in zip(batch["id"].tolist(), batch["text"], batch["places"], strict=True):
                raw = (unpack(text) or "").encode("utf-8", "surrogatepass")
                for p in places if places is not None else ():
                    if p["at"] >= 0:
                        q, k = p["at"] // 4, settings.cores[p["at"] % 4]
                        begin = max(0, q - (settings.window - k))
                        rows.append((p["to"], i, p["at"], q - begin, raw[begin:q + settings.window]))
            yield pd.DataFrame(rows, columns=["key", "id", "at", "left", "bytes"])
    return read


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif end > start:
            out.append([start, end])
    return out


def _with_spans(docs: DataFrame, id_col: str, text_col: str, settings: Settings, fields: str, made) -> DataFrame:
    """id and ``fields`` for each row of ``docs``; ``made``: what these are for a text and its spans."""
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = read.where("id is not null")
    shared = docs.sparkSession.sparkContext.broadcast(frequent_keys(named, settings))  # at most FREQUENT_KEPT keys
    found = named.mapInPandas(_anchor_rows(settings, shared), _ROWS).repartition("key").mapInPandas(
        _resolve(settings), "id long, at long, to long")
    # texts and places are read twice below; the exchange of each is made once
    places = found.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("at", "to")).alias("places"))
    texts = named.select("id", packed("text").alias("text"))
    held = texts.join(places, F.col("id") == F.col("_id"), "left").select("id", "text", "places")
    contexts = held.mapInPandas(
        _contexts(settings), "key long, id long, at long, left int, bytes binary")
    trees = contexts.repartition("key").mapInPandas(_tree_spans(settings), "id long, start long, end long")

    spans = trees.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("start", "end")).alias("found"))

    out = T.StructType.fromDDL(f"id long, {fields}")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text, places, found in zip(batch["id"], map(unpack, batch["text"]), batch["places"], batch["found"], strict=True):
                n = len((text or "").encode("utf-8", "surrogatepass"))
                spans = [(-p["at"] - 1, min(p["to"], n)) for p in (places if places is not None else ()) if p["at"] < 0]
                spans = merged(spans + [(s["start"], min(s["end"], n)) for s in (found if found is not None else ())])
                rows.append((None if pd.isna(i) else int(i), *made(text, spans)))
            yield pd.DataFrame(rows, columns=out.names, dtype=object).astype({"id": "Int64"})

    done = held.join(spans, F.col("id") == F.col("_id"), "left").select("id", "text", "places", "found")
    unnamed = read.where("id is null").select("id", packed("text").alias("text"), *(
        F.lit(None).cast(done.schema[c].dataType).alias(c) for c in ("places", "found")))
    return done.unionByName(unnamed).mapInPandas(finish, out).withColumnRenamed("id", id_col)


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs``: id, text, spans (of its UTF-8 bytes, [start, end), in order, apart).

    A null or empty text has no bytes, and a text of fewer than ``window`` bytes no span. A row that recurs with its id
    and text is one document; texts that share an id don't repeat each other at equal places. Rows with a null id have
    no spans and count for no other row. An empty table gives no rows; other columns are left out, whatever their names.
    """
    return _with_spans(docs, id_col, text_col, settings, "text string, spans array<array<long>>", lambda text, spans: (
        text, spans)).withColumnRenamed("text", text_col)


def kept_bytes(text: str | None, spans) -> bytes:
    raw, at, parts = (text or "").encode("utf-8", "surrogatepass"), 0, []
    for start, end in spans:
        parts.append(raw[at:start])
        at = end
    return b"".join([*parts, raw[at:]])


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256; the cases of ``repeat_spans`` hold."""
    def made(text: str | None, spans: list[list[int]]) -> tuple[int, int, int, str]:
        kept, removed = kept_bytes(text, spans), sum(e - s for s, e in spans)
        return len(kept) + removed, removed, len(spans), hashlib.sha256(kept).hexdigest()

    return _with_spans(docs, id_col, text_col, settings, "n_bytes long, n_removed long, n_spans long, kept_sha256 string", made)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """id and text without repeated bytes; a character cut in two is dropped. A null text stays null."""
    def made(text: str | None, spans: list[list[int]]) -> tuple[str | None]:
        return (None if text is None else kept_bytes(text, spans).decode("utf-8", "ignore"),)

    return _with_spans(docs, id_col, text_col, settings, "text string", made).withColumnRenamed("text", text_col)
