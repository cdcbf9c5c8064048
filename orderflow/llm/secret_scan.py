"""Operator 7: secret scans by dictionary-primed zstandard novelty.

Strings of a fixed shape (assignments to password-like names, access keys, long hex runs) are always reported. Other
candidates are long mixed strings near a word of sensitive context, on either side, or near a string that was found so;
strings of any characters assigned to such a word; and the lines of a private key's block. For each candidate the marginal compressed
size is measured: zstandard, primed with a dictionary of identifiers, compresses the surroundings with and without
it. A name or phrase that the dictionary or the surroundings hold adds few bytes, a random string nearly its own
entropy; strings above a share of bytes are reported as ``novel``.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import by_row

#: The base patterns, and the shortest group or match that counts.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more is what `[0-9a-f]+` gives with shorter ones dropped
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
KINDS = ("assign", "access", "hex", "novel")

#: Words of sensitive context, and how far from one, or after a candidate that was found, another may be.
CONTEXT_WORDS = ("password", "passwd", "passphrase", "secret", "token", "apikey", "api_key", "api key", "credential",
                 "private", "bearer", "authorization", "signature", "access_key", "access key", "client_id", "pwd")
CONTEXT = re.compile("|".join(CONTEXT_WORDS), re.I | re.A)
CONTEXT_CHARS = 40
CANDIDATE_CHARS, LONG_RUN = 16, 1000
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_CHARS},}}")
#: What a context word may be a part of.
NAME = re.compile(r"[\w.-]+", re.A)
#: What is assigned to a context word: quoted, or up to a space; only phrases of these words hold spaces.
ASSIGNED = re.compile(
    r"[\"'\]]*\x20*(:?=>?|:)\x20*(?:\"((?:\\.|[^\"\\\n])+)\"|'((?:\\.|[^'\\\n])+)'|([^\s\"'`]+))", re.A)
ASSIGNED_CHARS = 6
PHRASE_WORDS = ("password", "passwd", "passphrase", "pwd")
#: The lines of a private key, and the last one, however short.
KEY_BLOCK = re.compile(r"-----BEGIN [^\n-]*PRIVATE KEY[^\n-]*-----(.*?)(?=-----END|\Z)", re.S)
KEY_END = re.compile(r"\s+([A-Za-z0-9+/]+={0,2})\s*-----END")
#: Identifiers and phrases that aren't secrets.
IDENTIFIERS = """
access_key access_token account_id address api_key api_key_id apikey application_id attribute auth_token authorization
basic_auth bearer_token certificate class client_id client_secret config configuration connection_string container
content_type controller credential credentials database_password database_url database_user default_value description
development document encryption_key environment environment_variable example example_password example_token factory
function get_password get_secret get_token hostname http://localhost/ https://www.example.com/ identifier implementation
index.html interface license localhost manager message module namespace oauth_token object option parameter passphrase
passwd password password_hash password_reset private_key production property provider public_key refresh_token registry
repository request response return secret_access_key secret_key secret_name secret_value security service service_account
session_id session_key session_token set_password signature signing_key ssh_key string test_password test_token
test_value testing token_type token_value transaction undefined update_password user_id user_name username validate value
variable version your_api_key_here your_password_here your_token_here changeme placeholder xxxxxxxxxxxxxxxx
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789
"""
AROUND_CHARS = 400
MIN_SHARE = 0.6

_COMPRESSOR: zstandard.ZstdCompressor | None = None


def _compressor() -> zstandard.ZstdCompressor:
    """One primed compressor for each Python worker."""
    global _COMPRESSOR
    if _COMPRESSOR is None:
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _COMPRESSOR = zstandard.ZstdCompressor(level=9, dict_data=primed)
    return _COMPRESSOR


def novelty(text: str, start: int, end: int, around: int = AROUND_CHARS) -> float:
    """Marginal compressed bytes of ``text[start:end]`` for each byte of it, against its surroundings."""
    near = (text[max(0, start - around):start] + " " + text[end:end + around]).encode("utf-8", "surrogatepass")
    own = text[start:end].encode("utf-8", "surrogatepass")
    size = _compressor().compress
    return (len(size(near + b" " + own)) - len(size(near))) / max(1, len(own))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the strings with a fixed shape, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


class _Places:
    """Where in a text a pattern matches, to ask for the first match from a place on without scanning again."""

    def __init__(self, pattern: str, text: str):
        self.starts = [m.start() for m in re.finditer(pattern, text)]

    def within(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, start)
        return i < len(self.starts) and self.starts[i] < end


class _Scan:
    """Candidates of one text in sensitive context; every stretch of the text is walked a bounded number of times."""

    def __init__(self, text: str, base: list[tuple[int, int, int]], min_share: float):
        self.text, self.min_share = text, min_share
        self.runs = [m.span() for m in CANDIDATE.finditer(text)]
        self.run_starts, self.run_ends = [s for s, _ in self.runs], [e for _, e in self.runs]
        self.digits, self.letters, self.humps = (_Places(x, text) for x in ("[0-9]", "[A-Za-z]", "[a-z](?=[A-Z])"))
        self.words = [m.span() for m in CONTEXT.finditer(text)]
        self.names = [m.span() for m in NAME.finditer(text)]
        self.name_starts = [s for s, _ in self.names]
        self.base_starts = [s for s, _, _ in base]
        self.base_reach = list(accumulate((e for _, e, _ in base), max))
        self.found: dict[int, tuple[int, int, int]] = {}
        self.judged: set[tuple[int, int]] = set()
        self.seen: set[tuple[int, int, bool]] = set()
        self.values: dict[tuple[int, bool], tuple[int, int] | None] = {}
        # from where and how far a candidate may start, and whether letters alone may do: in what goes on from a secret
        self.ahead = [(e, e + CONTEXT_CHARS, True) for _, e, kind in base if kind == 0]

    def mixed(self, start: int, end: int) -> bool:
        return self.digits.within(start, end) and self.letters.within(start, end)

    def in_base(self, start: int, end: int, beyond: bool = False) -> bool:
        """Whether a string of a fixed shape overlaps; with ``beyond``, one that doesn't end within."""
        i = bisect_left(self.base_starts, end)
        reach = self.base_reach[i - 1] if i else 0
        return reach >= end if beyond else reach > start

    def take(self, start: int, end: int, beyond: bool = False, measured_from: int | None = None) -> None:
        """Reports a candidate if it is novel; the context then goes on behind it."""
        if (start, end) in self.judged or self.in_base(start, end, beyond):
            return
        self.judged.add((start, end))
        if novelty(self.text, start if measured_from is None else measured_from, end) >= self.min_share and end > self.found.get(start, (0, 0, 0))[1]:
            self.found[start] = start, end, 3
            self.ahead.append((end, end + CONTEXT_CHARS, True))

    def starting(self, at: int, most: int) -> Iterator[tuple[int, int]]:
        """Candidates that start from ``at`` to ``most``; the rest of a run that ``at`` falls in is one, up to the next
        context word if it is long."""
        i = bisect_right(self.run_ends, at)
        if i < len(self.runs) and self.runs[i][0] < at:
            end = self.runs[i][1]
            if end - at > LONG_RUN:
                k = bisect_left(self.words, (at, 0))
                end = min(end, self.words[k][0]) if k < len(self.words) else end
            if end - at >= CANDIDATE_CHARS:
                yield at, end
            i += 1
        while i < len(self.runs) and self.runs[i][0] <= most:
            yield self.runs[i]
            i += 1

    def assigned(self, start: int, end: int) -> tuple[int, int] | None:
        """Where the value is that is assigned to the context word at [start, end), if it can be a secret."""
        i = bisect_right(self.name_starts, end) - 1  # the name goes on to its own end, whatever follows the word
        at = self.names[i][1] if i >= 0 and self.names[i][1] > end else end
        phrase = self.text[start:end].lower() in PHRASE_WORDS
        if (at, phrase) not in self.values:
            self.values[at, phrase] = _value(self.text, at, phrase)
        return self.values[at, phrase]

    def pieces(self, start: int, end: int) -> Iterator[tuple[int, int]]:
        """A candidate, or of a long one what lies between the context words it holds itself."""
        if end - start <= LONG_RUN:
            yield start, end
            return
        i = bisect_left(self.words, (start, 0))
        at = start
        while i < len(self.words) and self.words[i][0] < end:
            if self.words[i][0] - at >= CANDIDATE_CHARS:
                yield at, self.words[i][0]
            at = max(at, self.words[i][1])
            i += 1
        if end - at >= CANDIDATE_CHARS:
            yield at, end

    def spans(self) -> list[tuple[int, int, int]]:
        for block in KEY_BLOCK.finditer(self.text):
            self.ahead.append((block.start(1), block.end(1), True))
            if last := KEY_END.search(self.text, max(block.start(1), block.end(1) - CONTEXT_CHARS * 2)):
                if last.start(1) < block.end(1):  # too short to measure alone: together with the line before it
                    before = self.text.rfind("\n", block.start(1), max(block.start(1), self.text.rfind("\n", 0, last.start(1))))
                    self.take(last.start(1), last.end(1), beyond=True, measured_from=max(block.start(1), before + 1))
        for start, end in self.words:
            self.ahead.append((end, end + CONTEXT_CHARS, False))
            for i in range(bisect_left(self.run_ends, start - CONTEXT_CHARS), bisect_right(self.run_ends, start)):
                self.judge(*self.runs[i], False)
            if value := self.assigned(start, end):
                self.take(*value, beyond=True)
        while self.ahead:
            at, most, goes_on = self.ahead.pop()
            for start, end in self.starting(at, most):
                self.judge(start, end, goes_on)
        spans, last = [], 0
        for span in sorted(self.found.values()):
            if span[1] > last:  # of a string within another only the whole one
                spans.append(span)
                last = span[1]
        return spans

    def judge(self, start: int, end: int, goes_on: bool) -> None:
        if (start, end, goes_on) in self.seen:
            return
        self.seen.add((start, end, goes_on))
        for s, e in self.pieces(start, end):
            if self.mixed(s, e) or goes_on and self.humps.within(s, e - 1):
                self.take(s, e)


def _value(text: str, at: int, phrase: bool) -> tuple[int, int] | None:
    if not (m := ASSIGNED.match(text, at)):
        return None
    group = next(g for g in (2, 3, 4) if m[g] is not None)
    own = m[group].rstrip(",;.()[]{}<>") if group == 4 else m[group]
    if len(own) < ASSIGNED_CHARS or not phrase and re.search(r"\s", own):
        return None
    if not (phrase and "=" in m[1]) and not re.search(r"[^\W\d_]", own) or not phrase and not re.search(r"[^A-Za-z_.-]", own):
        return None
    return m.start(group), m.start(group) + len(own)


def novel_spans(text: str, base: list[tuple[int, int, int]], min_share: float = MIN_SHARE) -> list[tuple[int, int, int]]:
    """Candidates in sensitive context, apart from ``base``, that the primed compressor can't shorten.

    A candidate that was found, or an assignment of ``base``, is context for those after it. An assigned value may
    go on where a string of ``base`` ends. Of a candidate of more than ``LONG_RUN`` characters the parts between the
    context words within it are measured.
    """
    low = text.lower()
    if not any(w in low for w in CONTEXT_WORDS):
        return []
    return _Scan(text, base, min_share).spans()


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_share: float = MIN_SHARE) -> DataFrame:
    """One row for each row of ``docs``: id, text, findings (kind, start, end in code points, novelty) in order.

    Strings of a fixed shape are reported whatever their novelty. A null or empty text has no findings; ties of start
    go by the order of ``KINDS``; repeated rows are scanned each; an empty table gives no rows; other columns are left
    out, whatever their names.
    """
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["text"]:
                base = base_spans(text or "")
                spans = sorted(base + novel_spans(text or "", base, min_share), key=lambda x: (x[0], x[2]))
                found.append([{"kind": KINDS[k], "start": s, "end": e, "novelty": novelty(text, s, e)}
                              for s, e, k in spans])
            yield pd.DataFrame({"id": batch["id"], "text": batch["text"], "findings": found})

    out = "text string, findings array<struct<kind: string, start: long, end: long, novelty: double>>"
    return by_row(docs, scan, id_col, out, text=text_col).withColumnRenamed("text", text_col)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def count(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(findings):
        return F.array_join(F.transform(findings, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = F.filter("findings", lambda x: x["kind"] != KINDS[3])
    return scanned.select(id_col, *(count(k) for k in KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                          joined(F.col("findings")).alias("spans"), count(KINDS[3]))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
           mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found string replaced by ``mark`` (overlapping ones by one); all rows and columns stay.

    ``length_col``, if there, becomes the new text's length. A null text stays null.
    """
    def scan(texts: pd.Series) -> pd.Series:
        done = []
        for text in texts:
            if not isinstance(text, str):
                done.append(None)
                continue
            base = base_spans(text)
            spans = sorted(base + novel_spans(text, base))
            parts, at = [], 0
            for s, e, _ in spans:
                if s >= at:
                    parts += [text[at:s], mark]
                at = max(at, e)
            done.append("".join(parts) + text[at:])
        return pd.Series(done, dtype=object)

    scan.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    new = F.pandas_udf(scan, T.StringType())
    out = docs.withColumn(text_col, new(F.col(text_col)))
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else out
