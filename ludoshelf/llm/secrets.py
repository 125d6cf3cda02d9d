"""Secret scan: fixed patterns, and values in a credential context that are hard to guess.

The guess cost of a value is found by dynamic programming: the cheapest way to cut it into words, dates, repeats,
keyboard walks and brute-force spans. A value that stays expensive is a secret though no fixed pattern fits.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

from pyspark.sql import DataFrame

from ludoshelf.llm.common import map_rows

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ASSIGN_CHARS = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters in all; a longer run's tail is never a match of its own
HEX = re.compile(r"[0-9a-f]{16,}")

#: A wider credential context; the value is its group 1.
CONTEXT = re.compile(
    r"(?i:passphrase|password|passwd|pwd|passcode|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)"
    r"[\"']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+)(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|([^\s\"'<>,;]{6,}))",
    re.ASCII,
)
#: A text that has none of these in lower case has neither an assignment nor a context.
MARKS = ("pass", "pwd", "secret", "token", "api", "access", "private", "credential", "auth")
#: log10 of the guesses from which a value counts as a secret.
HARD = 9.0
WORDS_PATH = "/opt/tokenizers/word_bpe_49k.json"

# Keyboard rows, and common substitutions of letters.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./", strict=True))
LEET = str.maketrans("@4301$57", "aaeoisst")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Frequent passwords, by rank.
COMMON = "password 123456 qwerty letmein admin welcome monkey dragon iloveyou abc123 login master secret changeme".split()

SEGMENT = 0.5  # log10 cost of one more segment
UNIT = 8  # longest unit of a repeat
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:1[0-2]|0?[1-9])[-/._]?(?:3[01]|[12]\d|0?[1-9])|(?:3[01]|[12]\d|0?[1-9])[-/._]?(?:1[0-2]|0?[1-9])[-/._]?(?:(?:19|20)\d\d|\d\d)")
YEAR = re.compile(r"(?:19|20)\d\d")


def word_ranks(path: str = WORDS_PATH) -> dict[str, int]:
    """Words of a public vocabulary by rank, frequent passwords first. At most as long as the vocabulary."""
    vocabulary = json.loads(open(path, encoding="utf-8").read())["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>") and w[:-4].isalpha() and len(w) > 6]
    return {w: rank for rank, w in reversed(list(enumerate([*COMMON, *words], 1)))}


AT = {c: (x + y / 2, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}


def _neighbours() -> dict[str, set[str]]:
    near = {a: {b for b, q in AT.items() if a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1} for a, p in AT.items()}
    for row in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
        for a, b in zip(row, row[1:], strict=False):
            near[a].add(b)
            near[b].add(a)
    return near


NEAR = _neighbours()


def _direction(a: str, b: str) -> tuple[float, float]:
    step = ord(b) - ord(a)
    if abs(step) == 1:
        return step, 0
    return AT[b][0] - AT[a][0], AT[b][1] - AT[a][1]


def _alphabet(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def _cases(word: str) -> float:
    upper = sum("A" <= c <= "Z" for c in word)
    if not upper:
        return 0.0
    if upper in (1, len(word)) and "A" <= word[0] <= "Z" or upper == len(word):
        return math.log10(2)
    return min(upper, len(word) - upper) * math.log10(2) + math.log10(len(word))


def guess_cost(value: str, ranks: dict[str, int], longest: int | None = None) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes; 0 for an empty value.

    Time is linear in the value: words are at most as long as the longest known word, a repeat's unit has at most
    ``UNIT`` characters, and of repeats and keyboard walks the longest runs count.
    """
    n, low = len(value), value.translate(LOWER)
    longest = longest or max(map(len, ranks), default=0)
    plain = "".join(SHIFTED.get(c, c) for c in low)
    leet = low.translate(LEET)
    spans: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    swapped = [0]
    for a, b in zip(low, leet, strict=True):
        swapped.append(swapped[-1] + (a != b))
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(low[i:j])
            if rank is None and swapped[j] > swapped[i] and (rank := ranks.get(leet[i:j])) is not None:
                rank *= 2 ** min(swapped[j] - swapped[i], 60)
            if rank is not None:
                spans[i].append((j, math.log10(rank + 1) + _cases(value[i:j])))
        if low[i].isdigit():
            if m := DATE.match(low, i):
                spans[i].append((m.end(), math.log10(365.25 * 120) + (0.6 if not m[0].isdigit() else 0)))
            if m := YEAR.match(low, i):
                spans[i].append((m.end(), math.log10(120)))
    i = 0
    while i < n - 1:  # keyboard walks
        j = i + 1
        while j < n and plain[j] in NEAR.get(plain[j - 1], ()):
            j += 1
        if j - i >= 3:
            turns = sum(_direction(plain[k - 1], plain[k]) != _direction(plain[k - 2], plain[k - 1]) for k in range(i + 2, j))
            spans[i].append((j, math.log10(47 * (j - i)) + (1 + turns) * math.log10(4.6) + _cases(value[i:j])))
        i = max(j - 1, i + 1)
    for unit in range(1, min(UNIT, n // 2) + 1):  # repeats
        run = 0
        for k in range(n - unit + 1):
            if k < n - unit and low[k] == low[k + unit]:
                run += 1
                continue
            if run >= unit and (unit > 1 or run >= 2):
                for i in range(k - run, min(k - run + unit, k)):
                    times = (k + unit - i) // unit
                    if times >= 2:
                        spans[i].append((i + times * unit, sum(map(_alphabet, low[i : i + unit])) + math.log10(times) + _cases(value[i : i + unit])))
            run = 0
    best, brute = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    for i in range(n):
        brute[i + 1] = min(brute[i], best[i] + SEGMENT) + _alphabet(value[i])
        best[i + 1] = min(best[i + 1], brute[i + 1])
        for j, cost in spans[i]:
            best[j] = min(best[j], best[i] + cost + SEGMENT)
    return best[n]


def digest(spans: list[tuple[int, int, str]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then in the order of kinds."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], kinds.index(s[2]), s[1])))


def marked(text: str) -> bool:
    low = text.lower()
    return any(mark in low for mark in MARKS)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS] if marked(text) else []
    found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return found + [(*m.span(), "hex") for m in HEX.finditer(text)]


def guessed_spans(text: str, ranks: dict[str, int], longest: int, base: list[tuple[int, int, str]], hard: float) -> tuple[list, float | None]:
    """Values in a credential context with a cost of ``hard`` or more that no base span covers, and the highest cost.

    A value of letters alone is prose unless it is assigned: after "is" it does not count.
    """
    found, highest = [], None
    if not marked(text):
        return found, highest
    for m in CONTEXT.finditer(text):
        group = next(g for g in (1, 2, 3) if m[g] is not None)
        value, (a, b) = m[group], m.span(group)
        if group == 3:
            value = value.rstrip(".!?)")
            b = a + len(value)
        if len(value) < 6 or value.isalpha() and not any("=" in x or ":" in x for x in (text[m.start() : a],)):
            continue
        cost = guess_cost(value, ranks, longest)
        highest = cost if highest is None else max(highest, cost)
        if cost >= hard and not any(x < b and a < y for x, y, _ in base):
            found.append((a, b, "guess"))
    return found, highest


def scan(docs: DataFrame, words_path: str = WORDS_PATH, hard: float = HARD) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): counts, base_sha256, all spans, n_guess, max_guess_log10.

    Base spans always stay. A null text counts as empty: zero counts, the digest of the empty string, no spans and a
    null max_guess_log10. Repeated rows are scanned alike; other columns are ignored. Texts are scanned whole.
    """
    known = docs.sparkSession.sparkContext.broadcast(word_ranks(words_path))

    def setup():
        ranks = known.value
        longest = max(map(len, ranks), default=0)

        def one(doc_id, text):
            text = text or ""
            base = base_spans(text)
            more, highest = guessed_spans(text, ranks, longest, base, hard)
            count = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
            sha = hashlib.sha256(digest(base, KINDS).encode()).hexdigest()
            return doc_id, *count, sha, digest(base + more, KINDS), len(more), highest

        return one

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_guess_log10 double"
    return map_rows(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), setup, schema)
