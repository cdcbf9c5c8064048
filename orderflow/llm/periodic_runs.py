"""Operator 11: periodic runs of words, by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping period q. Words are
appended to a stream, one or many at a time. For every power of two m, each completed aligned block of m words is a catcher
for squares of half length p from 2m - 1 to 4m - 2 (over all m that is every p once): any such square holds a whole block in
its first half, and its copy p words further. So

1. each new window of m words is compared by hash with the two blocks that lie such a distance before it; hashes of 2m words
   come from those of m words, and a level keeps only the last 5m of them;
2. blocks in a row that are caught with the same p are one stretch; it goes on by less than m words on either side, which is
   compared word by word. A stretch that reaches the end of the stream stays open until further words arrive;
3. stretches of p matching words and more hold squares; all squares of a stretch merge into one run. Of runs of equal ends the
   smallest period counts. A catcher whose whole square lies in a known run of a period up to m is left out: there p is a
   multiple of that period.

Runs that are reported are compared word by word over their length: a clash of hashes reports nothing false. Work is O(n log n),
memory O(n) for a stream of n words. Documents of a batch are dealt to streams by length; between them stands a word of its
own that equals no other, so no run crosses it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import by_row, mix64

#: A run is at least so many periods long, and has so many words.
MIN_EXPONENT, MIN_WORDS = 4, 6
#: Words that are appended at once, and words compared at once.
CHUNK, STEP = 1 << 18, 32

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _multiplier(level: int) -> np.uint64:
    """An odd factor for each level, 3 modulo 4."""
    return mix64(np.array([level + 1], np.uint64) * _ODD)[0] | np.uint64(3)


class _Level:
    """The catchers of blocks of ``m`` words: hashes of windows from ``base`` on, and stretches that are still open."""

    def __init__(self, m: int):
        self.m, self.base = m, 0
        self.hashes = np.zeros(0, np.uint64)
        self.open = np.zeros((0, 3), np.int64)  # p, first block, end of the last block

    def known(self) -> int:
        """Windows whose hash was made."""
        return self.base + len(self.hashes)


class RunCatcher:
    """Runs of a stream of words, given as integers; ``append`` takes words, ``finish`` ends the stream.

    ``min_exponent`` is at least 2; no run has more than ``longest`` words, if that is known. ``finish`` may be called at any
    time, words may be appended after it.
    """

    def __init__(self, min_exponent: int = MIN_EXPONENT, longest: int | None = None):
        self.min_exponent, self.longest = min_exponent, longest
        self.words = np.zeros(0, np.int64)
        self.levels = [_Level(1)]
        self.squares = np.zeros((0, 3), np.int64)  # start, end, period of all runs, those still open with their end so far

    def append(self, words: np.ndarray) -> None:
        for at in range(0, len(words), CHUNK):
            self._take(np.asarray(words[at:at + CHUNK], np.int64))

    def _take(self, words: np.ndarray) -> None:
        self.words = np.concatenate((self.words, words))
        n = len(self.words)
        level = self.levels[0]
        level.hashes = np.concatenate((level.hashes, mix64((words + 1).view(np.uint64) * _ODD)))
        found, k = [], 0
        while k < len(self.levels):
            level = self.levels[k]
            m = level.m
            if k:
                below = self.levels[k - 1]
                a = below.hashes[level.known() - below.base:n - m + 1 - below.base]
                b = below.hashes[level.known() + m // 2 - below.base:n - m // 2 + 1 - below.base]
                fresh = level.known()
                level.hashes = np.concatenate((level.hashes, a * _multiplier(k) + b)) if n >= m else level.hashes
            else:
                fresh = n - len(words)
            found.append(self._caught(level, fresh, np.concatenate((self.squares, *found)) if k else self.squares))
            # the next level starts with its first window, unless no run of its periods, 4m - 1 and more, is short enough
            if k + 1 == len(self.levels) and n >= 2 * m and (self.longest is None or self.min_exponent * (4 * m - 1) <= self.longest):
                self.levels.append(_Level(2 * m))
            k += 1
        self.squares = np.concatenate((self.squares, *found))
        for level in self.levels:
            if (drop := level.known() - 5 * level.m - level.base) > 0:
                level.hashes, level.base = level.hashes[drop:], level.base + drop

    def _caught(self, level: _Level, fresh: int, squares: np.ndarray) -> np.ndarray:
        """Runs of ``level`` by windows from ``fresh`` on; what was known of open ones is replaced by longer ones."""
        m, n, h, base = level.m, len(self.words), level.hashes, level.base
        start = np.arange(fresh, level.known())
        rest = start % m
        pairs = []
        for back in (2 * m + rest, np.where(rest == m - 1, m, 3 * m) + rest):
            block = start - back
            i = np.flatnonzero(block >= base)
            i = i[h[start[i] - base] == h[block[i] - base]]
            pairs.append(np.stack((back[i], block[i], block[i] + m), axis=1))
        caught = np.concatenate(pairs)
        inner = squares[squares[:, 2] <= m]
        if len(inner) and len(caught):
            inner = inner[np.argsort(inner[:, 0], kind="stable")]
            reach = np.maximum.accumulate(inner[:, 1])
            at = np.searchsorted(inner[:, 0], caught[:, 1], side="right") - 1
            caught = caught[(at < 0) | (reach[at] < caught[:, 2] + caught[:, 0])]
        caught = np.concatenate((level.open, caught))
        if not len(caught):
            return np.zeros((0, 3), np.int64)
        caught = caught[np.lexsort((caught[:, 1], caught[:, 0]))]
        p, first, end = caught.T
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (first[1:] > end[:-1])))
        heads = np.flatnonzero(new)
        p, first, end = p[heads], first[heads], np.maximum.reduceat(end, heads)
        right = self._matching(end, p, np.minimum(m, n - p - end), 1)
        waits = (end + right + p == n) & (right < m)
        level.open = np.stack((p, first, end), axis=1)[waits]
        left = self._matching(first - 1, p, np.minimum(m, first), -1)
        low, high = first - left, end + right
        some = high - low >= p
        return np.stack((low, high + p, p), axis=1)[some]

    def _matching(self, at: np.ndarray, p: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many words from ``at`` on, forward or backward, equal those ``p`` further; ``most`` at most."""
        count = np.zeros(len(at), np.int64)
        active = np.flatnonzero(most > 0)
        step = np.arange(STEP)
        while len(active):
            offset = count[active, None] + step
            inside = offset < most[active, None]
            place = np.where(inside, at[active, None] + way * offset, 0)
            same = inside & (self.words[place] == self.words[np.where(inside, place + p[active, None], 0)])
            run = np.where(same.all(axis=1), STEP, np.argmin(same, axis=1))
            count[active] += run
            active = active[(run == STEP) & (count[active] < most[active])]
        return count

    def finish(self) -> np.ndarray:
        """All runs, as rows (start, end, smallest period) by start, then period."""
        found = self.squares
        if len(found):
            # an open run was found again, longer, with each append: by start and period the last end holds
            found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
            last = np.concatenate(((found[1:, 0] != found[:-1, 0]) | (found[1:, 2] != found[:-1, 2]), [True]))
            found = found[last]
            # of equal ends the smallest period
            found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
            first = np.concatenate(([True], (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1])))
            found = found[first]
            found = found[found[:, 1] - found[:, 0] >= self.min_exponent * found[:, 2]]
        exact = [x for row in found for x in self._exact(*row.tolist())]
        return np.array(sorted(exact, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)

    def _exact(self, start: int, end: int, p: int) -> list[tuple[int, int, int]]:
        """The run itself if its words bear it out; if a clash of hashes made it, what of it does."""
        same = self.words[start:end - p] == self.words[start + p:end]
        if same.all():
            return [(start, end, p)]
        cuts = np.flatnonzero(~same)
        edges = np.concatenate(([-1], cuts, [len(same)]))
        return [(start + int(a) + 1, start + int(b) + p, p) for a, b in zip(edges[:-1], edges[1:], strict=True)
                if int(b) - int(a) - 1 >= (self.min_exponent - 1) * p]


def words_of(text: str | None) -> list[bytes]:
    """Words of the text, split at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def runs_of(documents: list[list[bytes]], min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """For each list of words its runs: rows (start, length, period), by start, then period."""
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(documents)
    classes: dict[int, list[int]] = {}
    for i, words in enumerate(documents):
        if len(words) >= max(min_words, min_exponent):
            classes.setdefault(len(words).bit_length(), []).append(i)
    for some in classes.values():
        sizes = np.array([len(documents[i]) for i in some])
        flat = np.empty(int(sizes.sum()), object)
        flat[:] = [w for i in some for w in documents[i]]
        codes = pd.factorize(flat)[0]
        # behind each document a word of its own
        ends = np.cumsum(sizes)
        starts = np.concatenate(([0], ends[:-1] + np.arange(1, len(some))))
        stream = np.insert(codes, ends, len(flat) + np.arange(len(some)))
        catcher = RunCatcher(min_exponent, int(sizes.max()))
        catcher.append(stream)
        found = catcher.finish()
        found = found[found[:, 1] - found[:, 0] >= min_words]
        owner = np.searchsorted(starts, found[:, 0], side="right") - 1
        cut = np.searchsorted(owner, np.arange(len(some) + 1))
        for k, i in enumerate(some):
            if cut[k] < cut[k + 1]:
                rows = found[cut[k]:cut[k + 1]]
                out[i] = np.stack((rows[:, 0] - starts[k], rows[:, 1] - rows[:, 0], rows[:, 2]), axis=1)
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words, of each run its first period only, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    change = [0] * (len(words) + 1)
    for start, length, period in runs.tolist():
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(w for w, covered in zip(words, accumulate(change), strict=False) if not covered)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_exponent: int = MIN_EXPONENT,
                  min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, runs (array of start, length, period; by start, then period), collapsed.

    ``collapsed`` is the text without what a run repeats after its first period. A null or blank text has no words, no
    runs and an empty ``collapsed``. Repeated rows are read each, null ids stay null; an empty table gives no rows; other
    columns are left out, whatever their names.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(t) for t in batch["text"]]
            runs = runs_of(words, min_exponent, min_words)
            yield pd.DataFrame({
                "id": batch["id"], "n_words": [len(w) for w in words],
                "runs": [[{"start": a, "length": b, "period": c} for a, b, c in r.tolist()] for r in runs],
                "collapsed": [collapsed(w, r).decode("utf-8", "replace") for w, r in zip(words, runs, strict=True)]})

    return by_row(docs, read, id_col, "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
                  text=text_col)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of ``docs`` with a tenth of the texts, chosen by a checksum of the id, made periodic from some word on.

    With h = crc32(decimal id) and g = h // 10: where h is divisible by 10, each word i >= a becomes word a + (i - a) % p,
    a = g % n, p = 1 + (n - a) // (3 + g % 8). Texts without words and rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    planted = docs.select(id_col, text_col).withColumn("_w", F.when((h % 10 == 0) & F.col(text_col).isNotNull(), words)).withColumn(
        "_g", F.floor(h / 10)).withColumn("_n", F.size("_w"))
    n, g = F.col("_n"), F.col("_g")
    a = F.when(n > 0, g % n)
    planted = planted.withColumn("_a", a).withColumn("_p", 1 + F.floor((n - a) / (3 + g % 8)))

    def word(i: Column) -> Column:
        at = F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
        return F.get("_w", at.cast("int"))

    made = F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), word), " ")
    return planted.withColumn(text_col, F.when(n > 0, made).otherwise(F.col(text_col))).drop("_w", "_g", "_n", "_a", "_p")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli of the longest run, runs_sha256, collapsed_sha256)."""
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("_best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        (-F.col("_best.less")).alias("length"), F.col("_best.period").alias("period"),
        F.floor(-1000 * F.col("_best.less") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
