"""Personal data: fixed patterns, and a span classifier trained from weak supervision.

Candidate spans that no fixed pattern covers are voted on by labelers: regular expressions, gazetteers and
context cues say yes, no or nothing. Expectation-maximisation over all candidates estimates how reliable each labeler is,
with no labels, and its posteriors train a logistic classifier of votes and shape. Spans that it accepts are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludoshelf.llm.common import map_rows, stage
from ludoshelf.llm.secrets import digest
from ludoshelf.sources.staging import Staging

BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "iban", "handle", "name")
KINDS = BASE + ADDED

# An address is sought from its "@", an ip only at the start of a run of digits: both find the same matches, in time linear in the text.
LOCAL_PART = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

CANDIDATES = {
    "number": re.compile(r"[0-9(][0-9().\x20/-]{5,28}[0-9](?!\w)"),
    "iban": re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
    "handle": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]+)+"),
    "name": re.compile(r"[A-ZÀ-Þ][a-zß-ÿ'-]+(?:\x20[A-ZÀ-Þ][a-zß-ÿ'-]+){1,2}(?!\w)"),
}
DOT = re.compile(r"(?:\(dot\)|\[dot\]|\x20dot\x20)")
NOT_BEFORE = {"number": re.compile(r"[\w.+-]\Z"), "iban": re.compile(r"\w\Z"), "handle": re.compile(r"(?!)"), "name": re.compile(r"\w\Z")}
# Where prose sets a capital letter anyway: the start of a text, line or sentence. A title's full stop ends no sentence.
OPENING = re.compile(r"(?:[.!?] |\n|\A)\Z")
TITLE = re.compile(r"\b(?i:mr|mrs|ms|dr|prof)\. \Z", re.ASCII)

GIVEN = frozenset(
    "James Mary John Linda Robert Susan Michael Karen William Nancy David Lisa Thomas Anna Peter Maria Paul Laura Daniel Sarah Hans Klaus Heike Ursula Jean Marie Pierre "
    "Camille Juan Carmen Carlos Lucia Ana Sofia Luis Elena Emma Olivia Lucas Noah Mia Leon Hannah Jonas Julie Louis Chloe Hugo Diego Pablo Marta".split()
)
FAMILY = frozenset(
    "Smith Jones Brown Taylor Wilson Miller Davis Moore Clark Lewis Walker Young King Wright Green Baker Mueller Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker "
    "Martin Bernard Dubois Moreau Laurent Garcia Martinez Lopez Sanchez Perez Gonzalez Rodriguez Fernandez".split()
)
NO_NAME = frozenset("January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday The This That".split())
# Characters of an iban by country.
IBAN_CHARS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22,
    "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}
CUES = re.compile(
    r"(?i:phone|tel|call|mobile|cell|fax|contact|ssn|social security|passport|account|iban|licen[cs]e|insurance|mr|mrs|ms|dr|name|signed|born|e-?mail|reach|write to)[\s.:#-]*(?:\w+\s)?\(?$", re.ASCII
)
NAME_CUES = re.compile(r"\b(?i:mr|mrs|ms|dr|prof|name|named|signed|dear|regards|sincerely)(?:\sis)?[\s.,:#-]*\Z", re.ASCII)
NO_CUES = re.compile(r"(?i:page|pages|isbn|issn|version|order|invoice|total|price|figure|table|section|chapter|sku|build|year|years)[\s.:#-]*\(?$|[$€£]\s?$", re.ASCII)
DATE = re.compile(r"(?:(?:19|20)[0-9]{2}[-./ ][0-9]{1,2}[-./ ][0-9]{1,2}|[0-9]{1,2}[-./ ][0-9]{1,2}[-./ ](?:19|20)[0-9]{2})(?![0-9])|(?:19|20)[0-9]{2}\s?[-/]\s?(?:19|20)[0-9]{2}$")
LOCAL = re.compile(r"\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}$|[0-9]{3}-[0-9]{2}-[0-9]{4}$")
CONTEXT = 40  # characters before a candidate that context labelers see

ACCEPT = 0.9
ROUNDS = 200


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of local part, "@" and dotted domain: each begins as far left of its "@" as the match before allows."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        after = domain.end() if domain else at + 1
        if domain:
            yield start, after
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*span, "email") for span in emails(text)]
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((*m.span(), "phone"))
    return found


def _mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


# Labelers: 1 yes, 0 no, None nothing. They see the kind, the candidate and the text before it.


def _by_form(kind, span, before):
    if kind == "number":
        return 1 if LOCAL.match(span) else 0 if span.isdigit() else None
    if kind == "handle":
        return 1 if "(" in span or "[" in span else None
    return None


def _by_checksum(kind, span, before):
    return int(_mod97(span)) if kind == "iban" else None


def _by_ending(kind, span, before):
    """An iban's length by its country, a handle's last label."""
    if kind == "iban":
        return int(IBAN_CHARS.get(span[:2]) == len(span.replace(" ", "")))
    if kind == "handle":
        last = DOT.split(span)[-1].strip()
        return int(last.isalpha() and 2 <= len(last) <= 6)
    return None


def _by_gazetteer(kind, span, before):
    if kind != "name":
        return None
    first, *_, last = span.split(" ")
    return 1 if first in GIVEN or last in FAMILY else 0 if first in NO_NAME or last in NO_NAME else None


def _by_full_gazetteer(kind, span, before):
    if kind != "name":
        return None
    first, *_, last = span.split(" ")
    return 1 if first in GIVEN and last in FAMILY else None


def _by_cue(kind, span, before):
    return 1 if CUES.search(before) else None


def _by_name_cue(kind, span, before):
    return 1 if kind == "name" and NAME_CUES.search(before) else None


def _by_other_cue(kind, span, before):
    return 0 if NO_CUES.search(before) else None


def _by_date(kind, span, before):
    return 0 if kind == "number" and DATE.match(span) else None


def _by_length(kind, span, before):
    if kind != "number":
        return None
    digits = sum(c.isdigit() for c in span)
    return 0 if digits > 13 or span.count(".") == 1 and digits < 9 else 1 if 9 <= digits <= 11 else None


#: Each labeler with how often it is expected to be right where it votes on a true and on a false candidate.
LABELERS = {
    _by_form: (0.95, 0.95), _by_checksum: (0.999, 0.99), _by_ending: (0.9, 0.8), _by_gazetteer: (0.9, 0.9), _by_full_gazetteer: (0.95, 0.97),
    _by_cue: (0.8, 0.9), _by_name_cue: (0.9, 0.95), _by_other_cue: (0.9, 0.8), _by_date: (0.95, 0.9), _by_length: (0.8, 0.7),
}
#: One more labeler's vote is added when all documents are read: both of a name's words follow name cues somewhere in the corpus.
LEARNT = (0.9, 0.9)
TOLD = np.array([*LABELERS.values(), LEARNT]).T
#: The least share of true candidates that is assumed: few numbers and capital words are personal, most spelled-out addresses are.
FLOOR = {"number": 0.05, "iban": 0.1, "handle": 0.3, "name": 0.05}
CUED_SHARE = 0.2  # of the occurrences of a word in names: from here on a word that follows name cues is a learnt name


def _opens(kind: str, before: str) -> bool:
    """Whether a name stands where any word has a capital letter; part of the candidate's shape."""
    return kind == "name" and bool(OPENING.search(before)) and not TITLE.search(before)


def _votes(kind: str, span: str, before: str) -> str:
    return "".join("-" if (v := label(kind, span, before)) is None else str(v) for label in LABELERS)


def _spans(text: str, kind: str) -> Iterator[tuple[int, int, str, bool]]:
    """(start, end, votes, at an opening) of the matches of a kind, in order. A name is also tried one word later where its first
    word is the tail of another word, or may be a mere opener: no given name, at an opening, with votes that are no better."""
    regex, at = CANDIDATES[kind], 0

    def read(m: re.Match) -> tuple[int, int, str, bool]:
        before = text[max(0, m.start() - CONTEXT) : m.start()]
        return *m.span(), _votes(kind, m[0], before), _opens(kind, before)

    def balance(votes: str) -> int:
        return votes.count("1") - votes.count("0")

    while m := regex.search(text, at):
        a, at = m.span()
        first = m[0].split(" ")[0]
        if NOT_BEFORE[kind].search(text[max(0, a - 2) : a]):
            at = a + len(first) if kind == "name" else at
            continue
        span = read(m)
        if span[3] and first not in GIVEN:
            later = regex.match(text, a + len(first) + 1)
            if later and balance((other := read(later))[2]) >= balance(span[2]):
                span, at = other, later.end()
        yield span


def candidates(text: str, base: Sequence[tuple[int, int, str]]) -> list[tuple[int, int, str, str, str, bool]]:
    """(start, end, kind, votes, shape, after a name cue) of spans that touch no base span or candidate of an earlier kind."""
    out, taken = [], bytearray(len(text))
    for a, b, _ in base:
        taken[a:b] = b"\1" * (b - a)
    for kind in CANDIDATES:
        if kind == "handle" and not DOT.search(text):
            continue
        for a, b, votes, opens in _spans(text, kind):
            if taken.find(1, a, b) >= 0:
                continue
            if kind == "number" and not 7 <= sum(c.isdigit() for c in text[a:b]) <= 19:
                continue
            taken[a:b] = b"\1" * (b - a)
            shape = f"{min((b - a) // 4, 9)}{min(sum(not c.isalnum() for c in text[a:b]), 3)}{int(opens)}"
            cued = kind == "name" and bool(NAME_CUES.search(text[max(0, a - CONTEXT) : a]))
            out.append((a, b, kind, votes, shape, cued))
    return out


def reliabilities(
    votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, told: np.ndarray | None = None, floor: float = 0.001
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of yes per row of ``votes`` (1, 0, -1 for nothing) and, per labeler, how often it is right on yes and on no.

    Expectation-maximisation for the two classes. Without ``told`` it starts from the share of yes votes, and pseudo-counts say that a labeler is
    right four times of five until the candidates say otherwise. ``told`` (two rows, a column per labeler) is what is expected of the
    labelers: it is the start, and stays half of every estimate, so that a class cannot be taken over by what is merely frequent. A labeler that
    only ever says one thing here does not show how often it is wrong, and stays as told.
    ``floor`` is the least share of the class yes.
    """
    yes, no = votes == 1, votes == 0

    def posteriors(right: np.ndarray, prior: float) -> np.ndarray:
        score = np.log(prior / (1 - prior)) + yes @ np.log(right[0] / (1 - right[1])) + no @ np.log((1 - right[0]) / right[1])
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))

    if told is None:
        cast = np.maximum(yes.sum(1) + no.sum(1), 1)
        posterior = np.clip(0.5 + (yes.sum(1) - no.sum(1)) / (2 * cast), 0.05, 0.95)
        posterior[(yes | no).sum(1) == 0] = 0.05
        right, expected = np.full((2, votes.shape[1]), 0.8), np.full((2, votes.shape[1]), 0.8)
    else:
        right, expected = told, told
        posterior = posteriors(told, floor)
    for _ in range(rounds):
        on, off = posterior * counts, (1 - posterior) * counts
        cast = np.stack([on @ (yes | no), off @ (yes | no)])
        good = np.stack([on @ yes, off @ no])
        weight = 10.0 if told is None else 10.0 + cast
        right = np.clip((weight * expected + good) / (weight + cast), 0.5, 0.999)
        if told is not None:
            right = np.where(yes.any(0) & no.any(0), right, told)
        prior = np.clip((1 + on.sum()) / (2 + counts.sum()), floor, 0.5)
        new = posteriors(right, prior)
        moved, posterior = np.abs(new - posterior).max(initial=0), new
        if moved < 1e-6:
            break
    return posterior, right


def features(pattern: str) -> np.ndarray:
    _, votes, shape = pattern.split(" ")
    values = [1.0]
    for v in votes:
        values += [float(v == "1"), float(v == "0")]
    return np.array([*values, int(shape[0]) / 9, int(shape[1]) / 3, int(shape[2])])


def train(patterns: Sequence[str], counts: Sequence[int]) -> dict[str, float]:
    """The final classifier's probability of each pattern: for each kind a logistic model, fitted by Newton steps to the posteriors of its candidates."""
    found: dict[str, float] = {}
    for kind in ADDED:
        of = [k for k, p in enumerate(patterns) if p.split(" ")[0] == kind]
        if not of:
            continue
        own, weight = [patterns[k] for k in of], np.array([counts[k] for k in of], float)
        votes = np.array([[-1 if v == "-" else int(v) for v in p.split(" ")[1]] for p in own])
        target, _ = reliabilities(votes, weight, told=TOLD, floor=FLOOR[kind])
        # A pattern weighs by the root of its count: a frequent one is met well, a rare one is not given up for it.
        weight, x = np.sqrt(weight), np.stack([features(p) for p in own])
        w, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (target - p)) - ridge @ w
            step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, slope)
            w += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-6:
                break
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        found |= dict(zip(own, p.tolist(), strict=True))
    return found


def _with_learnt(read: DataFrame, staged: Staging) -> DataFrame:
    """``read`` with the pattern of each of ``more`` complete: kind, votes, the learnt vote and shape.

    A word is a learnt name if it follows a name cue and does so in ``CUED_SHARE`` of its occurrences in names. Words are counted over all
    documents and joined to the names by word; what is gathered again per row is as long as the row's own list.
    """
    names = read.select("uid", F.posexplode("more").alias("pos", "m")).where("m.kind = 'name'").select("uid", "pos", "m.first", "m.last", "m.cued")
    names = staged(names, "pii_names")
    words = names.select(F.explode(F.array("first", "last")).alias("word"), "cued").groupBy("word").agg(F.count("*").alias("n"), F.count_if("cued").alias("c"))
    learnt = staged(words.where(f"c > 0 and c >= {CUED_SHARE} * n").select("word"), "pii_words")
    for end in ("first", "last"):
        names = names.join(learnt.withColumnRenamed("word", end), end, "left_semi")
    both = names.groupBy("uid").agg(F.collect_set("pos").alias("known"))
    vote = F.expr(
        "transform(more, (m, i) -> struct(m.start as start, m.end as end, m.kind as kind, "
        "concat(m.kind, ' ', m.votes, if(array_contains(known, i), '1', '-'), ' ', m.shape) as pattern))"
    )
    return staged(read.join(both, "uid", "left").select("*", vote.alias("judged")).drop("uid", "more", "known"), "pii_patterns")


def find(docs: DataFrame, accept: float = ACCEPT, staged: Staging | None = None) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): counts of base spans, base_sha256, all spans, and n_added.

    A candidate is added if the classifier's probability is ``accept`` or more and some labeler said yes. What is gathered for
    training is the count of each pattern (kind, votes and shape), over all candidates of all documents; their number is bounded by the
    number of labelers. A null text counts as empty: zero counts, the digest of the empty string, no spans.
    Repeated rows count as often as they stand; other columns are ignored. Texts are read whole, in time linear in their length.
    """
    spark = docs.sparkSession
    staged = staged or stage(spark)

    def setup():
        def one(doc_id, text):
            text = text or ""
            base = base_spans(text)
            count = [sum(s[2] == kind for s in base) for kind in BASE]
            more = []
            for a, b, kind, votes, shape, cued in candidates(text, base):
                first, *_, last = text[a:b].split(" ") if kind == "name" else ("", "")
                more.append({"start": a, "end": b, "kind": kind, "votes": votes, "shape": shape, "cued": cued, "first": first, "last": last})
            return doc_id, *count, hashlib.sha256(digest(base, KINDS).encode()).hexdigest(), [{"start": a, "end": b, "kind": k} for a, b, k in base], more

        return one

    schema = (
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start: int, end: int, kind: string>>, "
        "more array<struct<start: int, end: int, kind: string, votes: string, shape: string, cued: boolean, first: string, last: string>>"
    )
    found = map_rows(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), setup, schema)
    read = _with_learnt(staged(found.withColumn("uid", F.monotonically_increasing_id()), "pii_candidates"), staged)
    seen = read.select(F.explode("judged.pattern").alias("pattern")).groupBy("pattern").count().orderBy("pattern").collect()
    known = train([r.pattern for r in seen], [r["count"] for r in seen])
    accepted = [p for p, share in known.items() if share >= accept and "1" in p.split(" ")[1]]
    # At most as many patterns as votes and shapes allow; their array is a constant of the plan.
    good = F.array(*map(F.lit, accepted)).cast("array<string>")
    added = F.filter("judged", lambda m: F.array_contains(good, m["pattern"]))
    order = F.array(*map(F.lit, KINDS))
    spans = F.concat("base", F.transform(added, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"))))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return read.select("doc_id", *[f"n_{k}" for k in BASE], "base_sha256", text.alias("spans"), F.size(added).cast("long").alias("n_added"))
