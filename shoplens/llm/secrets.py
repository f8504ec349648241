"""Secret scan: base patterns, and password guess cost of credential values (op 7).

Base spans are three patterns (assign, access, hex), leftmost and
non-overlapping per kind.  The method adds spans of kind ``guess``: values in a
credential context (``pwd: x``, ``Bearer x``, ``passphrase is "x y"``, ``my_key = x``,
``://user:x@`` ..., with any blanks and, behind a colon or equals sign, on the next
line) that are hard to guess.  The cost of a value is the least total of ``log10`` guesses over
all segmentations into common words, dates, repeats, keyboard walks and
brute-force spans, found by dynamic programming over its characters; a value
costing ``MIN_GUESSES`` or more is a secret, a plain word or date after
"password is" is not.  The words are a short fixed list and the commonest words of
the documents (at most ``MAX_WORDS``, ranked by count), counted outside credential
values, so copies of a secret don't make it a word.

Defined cases: null text is empty and has no spans; repeated rows get a row
each; an empty table gives no rows; a text of any length is read whole; words of equal
count are words together or not at all; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.staging import Staging, documents, keys_and_text

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

# Credential contexts: those of the base pattern, which has no left bound, and others; the value follows.
# Blanks are of any number; a line may end behind a colon or an equals sign.  A value in
# quotes goes on to the closing quote.
CONTEXT = re.compile(
    r"""(?:(?:(?<![A-Za-z0-9])(?:pass\x20?phrase|passcode|password|passwd|pwd|pass|pin|secret|token|credentials?|"""
    r"""auth(?:orization)?|bearer|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret)|(?<=[A-Za-z0-9][_-])key)"""
    r"""["']?[\x20\t]*+(?:(?:=>|[:=])\s*+|(?:is|was|bearer|basic)[\x20\t]*+|(?<=[\x20\t]))|"""
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\s*+)["']?"""
    r"""(?:(?:bearer|basic|digest|token|negotiate|ntlm|oauth|hawk|mac|api-?key|key)\x20++)?["']?"""
    r"""((?<=")[^"\n]{4,}+(?=")|(?<=')[^'\n]{4,}+(?=')|[^\s"'<>]{4,})""", re.I | re.A)
# user:password@ of an address.
ADDRESS = re.compile(r"""://[^\s/:@"'<>]*+:([^\s/@"'<>]{4,}+)@""")
# A line that is a passphrase: five words or more behind a colon or an equals sign.
PHRASE = re.compile(r"""(?<![A-Za-z0-9])(?:pass\x20?phrase|password|passwd|pwd)[\x20\t]*+[:=]\s*+([a-z]{3,}(?:[\x20-][a-z]{3,}){4,})[\x20\t]*+(?:\n|$)""", re.I | re.A)
# Words of sentences rather than of passphrases.
SENTENCE_WORDS = frozenset("the and for with that this from your here you are was has have had not but can will please must should which when then than".split())
_KEY = re.compile("key", re.I)
LONGEST_CUE = 24          # no cue that ends a value, with its separator, is longer
CUES = ("pass", "pwd", "pin", "secret", "token", "credential", "auth", "bearer", "key")
MIN_GUESSES = 10.0        # log10 of the guesses from which a value counts as a secret

# Very common passwords and words of credential texts, the likeliest first.
COMMON = (
    "password", "123456", "qwerty", "admin", "letmein", "welcome", "monkey", "dragon", "login", "master", "secret", "test",
    "user", "root", "guest", "default", "changeme", "sunshine", "princess", "football", "iloveyou", "shadow", "hello",
    "summer", "winter", "spring", "autumn", "love", "god", "money", "freedom", "example", "sample", "dummy", "token", "key",
    "value", "none", "null", "true", "false", "your", "here", "the", "and", "for", "with", "that", "this", "from",
)
# Rows of a US keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (r, i) for r, row in enumerate(ROWS) for i, c in enumerate(row)}
_LEET = str.maketrans("@430157$!", "aaeoistsi")
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)|(?:19|20)\d\d")
_FULL_WALK, _STEP = 32, 32     # longest walk that may end anywhere; characters between two looks at the bound
_EXTRA = math.log10(2.0)      # one more factor for each further span of a segmentation
_WORD = re.compile(r"[^\W\d_]{3,}")
MAX_WORDS, MIN_COUNT, MAX_WORD = 200_000, 3, 40      # corpus words: number, least count, longest
_HELD = 200_000               # words a task holds before it hands on their counts


class WordList:
    """Rank by word: the fixed list, and the given words, commonest first."""

    def __init__(self, counted=()):
        self.rank = {w: i + 1 for i, w in enumerate(counted)}
        for i, w in enumerate(COMMON):
            self.rank[w] = min(i + 1, self.rank.get(w, i + 1))
        self.longest = max(map(len, self.rank))


FIXED = WordList()


def _alphabet(s: str) -> int:
    return (10 * any(c.isdigit() for c in s) + 26 * any("a" <= c <= "z" for c in s) + 26 * any("A" <= c <= "Z" for c in s)
            + 33 * any(not c.isalnum() for c in s)) or 1


def _word_cost(part: str, words: WordList = FIXED) -> float | None:
    """log10 guesses of a common word, in any case and with letters swapped for digits; None if no word."""
    low = part.lower()
    extra = 0.0
    rank = words.rank.get(low)
    if rank is None:
        rank, extra = words.rank.get(low.translate(_LEET)), math.log10(4)
    if rank is None:
        return None
    if part != low:
        extra += math.log10(2) if part[1:] == low[1:] or part == part.upper() else math.log10(2 ** len(part))
    return math.log10(rank + 1) + extra


def guess_cost(value: str, words: WordList = FIXED) -> tuple[float, list[tuple[str, int, int]]]:
    """Least log10 guesses over all segmentations, and that segmentation (kind, start, end)."""
    cost, back = _least(value, words, math.inf)
    parts, j = [], len(value)
    while j:
        i, kind = back[j]
        if parts and kind == "brute" and parts[-1][0] == "brute":
            parts[-1] = ("brute", i, parts[-1][2])
        else:
            parts.append((kind, i, j))
        j = i
    return cost, parts[::-1]


def is_hard(value: str, words: WordList = FIXED) -> bool:
    """Whether the whole value costs ``MIN_GUESSES`` or more; reads only as far as that is open."""
    return _least(value, words, MIN_GUESSES)[0] >= MIN_GUESSES


def _least(s: str, words: WordList, limit: float):
    """(least cost, back pointers) of the whole value, or a lower bound of it that reaches the limit.

    Spans are found from their first character on.  Every segmentation has an end
    at character i or a span across it, and further spans cost more than nothing:
    the least of the costs to i and of the spans across it bounds the whole.
    """
    n = len(s)
    per_char = math.log10(_alphabet(s))
    repeats = [_Runs(lambda k, w=w: s[k] == s[k + w], n - w) for w in range(1, min(8, n // 2) + 1)]
    walk = _Runs(lambda k: _next_key(s, k), n - 1)
    turns = [0]                                                          # changes of direction up to a place
    best, back = [0.0] + [math.inf] * n, [None] * (n + 1)
    across: set[int] = set()                                             # ends of spans that begin before i
    for i in range(n + 1):
        if i:
            # A brute-force span may begin anywhere; extending one costs its characters only.
            step = best[i - 1] + per_char + (_EXTRA if i > 1 and back[i - 1][1] != "brute" else 0.0)
            if step <= best[i]:
                best[i], back[i] = step, (i - 1, "brute")
        if i == n:
            break
        if i % _STEP == 0:
            across = {j for j in across if j > i}
            bound = min([best[i], *(best[j] for j in across)])
            if bound >= limit:
                return bound, back
        spans = []
        for j in range(i + 3, min(n, i + words.longest) + 1):
            c = _word_cost(s[i:j], words)
            if c is not None:
                spans.append((j, c, "word"))
        if s[i].isdigit():
            m = _DATE.match(s, i)
            if m:
                spans.append((m.end(), math.log10(365 * 120 if m.end() - i > 4 else 120), "date"))
        for width, run in enumerate(repeats, 1):                         # repeats of a block
            times = (run.end(i) - i + width) // width
            if times * width >= 3 and times > 1:
                spans.append((i + times * width, width * per_char + math.log10(times), "repeat"))
        last = walk.end(i) + 1                                           # keyboard walk: a prefix of it, or all
        if last - i >= 4:
            for k in range(len(turns), last - 1):
                turns.append(turns[-1] + (_next_key(s, k - 1) and _next_key(s, k) and _direction(s, k) != _direction(s, k - 1)))
            for j in (*range(i + 4, min(last, i + _FULL_WALK) + 1), *[last] * (last > i + _FULL_WALK)):
                spans.append((j, math.log10(94.0 * (j - i)) + (turns[j - 2] - turns[i]) * math.log10(4.0), "walk"))
        for j, c, kind in spans:
            c = best[i] + c + (_EXTRA if i else 0.0)
            if c < best[j]:
                best[j], back[j] = c, (i, kind)
                across.add(j)
    return best[n], back


class _Runs:
    """Runs of consecutive places below ``n`` where a test holds; each place is tested about once."""

    def __init__(self, holds, n: int):
        self.holds, self.n, self.until = holds, n, 0

    def end(self, i: int) -> int:
        """First place from ``i`` on where the test fails; to be asked with rising ``i``."""
        self.until = max(self.until, i)
        while self.until < self.n and self.holds(self.until):
            self.until += 1
        return self.until


def _next_key(s: str, k: int) -> bool:
    a, b = _PLACE.get(s[k].lower()), _PLACE.get(s[k + 1].lower())
    return a is not None and b is not None and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1


def _direction(s: str, k: int):
    a, b = _PLACE[s[k].lower()], _PLACE[s[k + 1].lower()]
    return b[0] - a[0], b[1] - a[1]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def contexts(text: str):
    """Matches of the credential contexts; the end of a value may be the next cue ('Authorization: Bearer x')."""
    at = 0
    while m := CONTEXT.search(text, at):
        yield m
        at = max(m.start(1), m.end() - LONGEST_CUE)


def guess_spans(text: str, base: list[tuple[int, int, int]], words: WordList = FIXED) -> list[tuple[int, int, int]]:
    """Credential values that are hard to guess and not whole inside a base span; one may overlap base spans."""
    low = text.lower()
    if not any(c in low for c in CUES) and "://" not in text:
        return []
    out, at = [], 0
    starts, reach = [s for s, _, _ in base], list(accumulate((e for _, _, e in base), max))

    def covered(start, end):
        before = bisect_right(starts, start)
        return bool(before) and reach[before - 1] >= end

    for m in contexts(text):
        start = m.start(1)
        value = _without_marks(m.group(1))
        end = start + len(value)
        if m.start() < at or len(value) < 4 or covered(start, end):
            continue
        core = value.rstrip("!?")
        if core.isalpha():
            value = core                           # the mark after a word adds nothing to its cost
        lead = text[m.start():start]
        if core.isalpha() and "\n" in lead or _KEY.match(lead) and not any(c.isdigit() for c in value):
            continue                               # the next line's first word; a key by a name, such as a column
        if is_hard(value, words):
            out.append((start, 3, end))
            at = m.end()
    more = [m for m in ADDRESS.finditer(text) if is_hard(m.group(1), words)] if "://" in text else []
    if "pass" in low or "pwd" in low:
        more += [m for m in PHRASE.finditer(text) if not SENTENCE_WORDS & set(re.split("[ -]", m.group(1).lower())) and is_hard(m.group(1), words)]
    for m in more:
        if not covered(*m.span(1)) and not any(s <= m.start(1) and m.end(1) <= e for s, _, e in out):
            out.append((m.start(1), 3, m.end(1)))
    return sorted(out)


def _without_marks(value: str) -> str:
    """The value without the marks of its sentence: ``.,;:`` and brackets closed but not opened in it."""
    surplus = {c: value.count(c) - value.count(o) for o, c in ("()", "[]", "{}")}
    end = len(value)
    while end and (value[end - 1] in ".,;:" or surplus.get(value[end - 1], 0) > 0):
        end -= 1
        if value[end] in surplus:
            surplus[value[end]] -= 1
    return value[:end]


def find_secrets(text: str | None, words: WordList = FIXED) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans) of a whole text, in code points, end exclusive."""
    text = text or ""
    base = base_spans(text)
    return base, guess_spans(text, base, words)


def _count_words(batches):
    counts = Counter()

    def table():
        return pa.RecordBatch.from_arrays([pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            text = text.as_py() or ""
            low = text.lower()
            if any(c in low for c in CUES):
                parts, at = [], 0
                for m in contexts(text):
                    parts.append(text[at:m.start(1)])
                    at = m.end()
                low = " ".join(parts + [text[at:]]).lower()
            counts.update(_WORD.findall(low))
            if len(counts) > _HELD:
                yield table()
                counts.clear()
    yield table()


def word_list(docs: DataFrame) -> WordList:
    """The fixed list with the commonest words of the texts, credential values aside."""
    counts = docs.select(docs["text"].cast("string").alias("text")).mapInArrow(_count_words, "word string, n bigint")
    counts = counts.where(F.char_length("word") <= MAX_WORD).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    staging = Staging(docs.sparkSession, "secrets")
    counts = staging.save(counts, "words")
    least, total = None, 0
    for n, of in sorted(((r["n"], r["of"]) for r in counts.groupBy("n").agg(F.count("*").alias("of")).collect()), reverse=True):
        total += of
        if total > MAX_WORDS:
            break                                  # words of one count stay or go together
        least = n
    rows = counts.where(F.col("n") >= least).collect() if least else []       # at most MAX_WORDS rows
    staging.drop(counts)
    return WordList(r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"])))


def spell(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


_RESULT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_guess bigint"


def _scan(batches, words: WordList):
    for batch in batches:
        n, digests, spans = [[], [], [], []], [], []
        for text in batch.column(1):
            base, more = find_secrets(text.as_py(), words)
            for k in range(3):
                n[k].append(sum(x[1] == k for x in base))
            n[3].append(len(more))
            digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
            spans.append(spell(base + more))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(x, pa.int64()) for x in n[:3]], pa.array(digests, pa.string()), pa.array(spans, pa.string()),
             pa.array(n[3], pa.int64())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])


def scan(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, digest of the base spans, all spans, number of added ones."""
    words = docs.sparkSession.sparkContext.broadcast(word_list(docs))
    return keys_and_text(docs).mapInArrow(lambda batches: _scan(batches, words.value), _RESULT)


def redact_text(text: str | None, mark: str = "[SECRET]", words: WordList = FIXED) -> str | None:
    if text is None:
        return None
    base, more = find_secrets(text, words)
    spans = sorted((s, e) for s, _, e in base + more)
    if not spans:
        return text
    out, at = [], 0
    for s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by a mark; ``n_chars`` follows, all columns stay."""
    at = docs.columns.index("text")
    words = docs.sparkSession.sparkContext.broadcast(word_list(docs))

    def run(batches):
        for batch in batches:
            texts = pa.array([redact_text(t.as_py(), words=words.value) for t in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out


def secrets_query(spark, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
