"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans, which always stay. Where they leave digits
or an ``@`` uncovered - two values side by side that one greedy match ran
together, a phone without ``+``, an email with spaces around its ``@`` - a
semi-Markov CRF (Sarawagi and Cohen, 2004) cuts the region into segments.
Features look at whole candidate spans (form, validity, shape, digits, check
sum, octets, neighbours, cue words); dynamic programming over spans of bounded
length picks boundaries and types jointly. Its score alone decides: a segment
is added unless it overlaps a base span.

The model is trained on regions of a bounded sample of the texts, labelled by
their base spans, on the same spans set side by side, on phones and emails of
the sample with the plus or the closeness taken away, and on fixed examples.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.llm.common import pieces, small_batches, stored

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

# Look-behinds only keep a failed start from being tried again inside its run;
# they change no match.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Runs that hold every match of the numeric patterns: from a digit or plus on.
NUMERIC = re.compile(r"[0-9+][0-9 ().+-]*")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.DOTALL)
CUE = re.compile(r"(phone|tel|call|mobile|fax|card|visa|credit|iban|ip|host|server|address|e-?mail|mail|contact)\W*$", re.IGNORECASE)
#: Forms that the patterns do not take: phones in groups without a plus, emails with
#: spaces at the ``@`` or a domain without a dot.
PLAIN = re.compile(r"(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}")
BROKEN = re.compile(r"[A-Za-z0-9._%+-]+\s?@\s?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
#: Characters of a segment of each type at most (local part and domain; octets with
#: leading zeros; 19 and 15 digits with separators), and of a region that is decoded at once.
LONGEST, WINDOW = (254, 23, 40, 40), 400
#: Characters before and after an ``@`` that a segment around it may take.
BEFORE, AFTER = 66, 190
#: Hashed features, and sampled texts and regions that are learned from at most.
SIZE, SAMPLE_TEXTS, SAMPLE_REGIONS = 512, 1_000, 300
#: Fixed examples, so that each type has some in any corpus.
EXAMPLES = (
    ("mail ann.lee@example.com or", (("email", "ann.lee@example.com"),)),
    ("from 10.20.30.40 and", (("ip", "10.20.30.40"),)),
    ("card 4111111111111111 was", (("card", "4111111111111111"),)),
    ("card 5500 0000 0000 0004 was", (("card", "5500 0000 0000 0004"),)),
    ("call +1 (212) 555-0100 now", (("phone", "+1 (212) 555-0100"),)),
    ("call +442079460000 now", (("phone", "+442079460000"),)),
    ("10.20.30.40 4111111111111111", (("ip", "10.20.30.40"), ("card", "4111111111111111"))),
    ("+1 (212) 555-0100 10.20.30.40", (("phone", "+1 (212) 555-0100"), ("ip", "10.20.30.40"))),
    ("4111111111111111 +1 (212) 555-0100", (("card", "4111111111111111"), ("phone", "+1 (212) 555-0100"))),
    ("4111111111111111 5500000000000004", (("card", "4111111111111111"), ("card", "5500000000000004"))),
    ("order 12345678 of 2024-01-02", ()),
    ("key=9f27300451a8873412ce", ()),
    ("1 2 3 4 5 6 7 8 9 10 11 12", ()),
    ("call (212) 555-0100 now", (("phone", "(212) 555-0100"),)),
    ("or (303) 555-0142, then", (("phone", "(303) 555-0142"),)),
    ("at 212-555-0100 or", (("phone", "212-555-0100"),)),
    ("tel 415.555.0133 is", (("phone", "415.555.0133"),)),
    ("phone: 020 7946 0018 in", (("phone", "020 7946 0018"),)),
    ("call 2125550100 now", (("phone", "2125550100"),)),
    ("(212) 555-0100 10.20.30.40", (("phone", "(212) 555-0100"), ("ip", "10.20.30.40"))),
    ("+49 (0) 30 12 34 56 79 10.20.30.41", (("phone", "+49 (0) 30 12 34 56 79"), ("ip", "10.20.30.41"))),
    ("mail ann.lee @ example.com or", (("email", "ann.lee @ example.com"),)),
    ("from joe_b@ example.org and", (("email", "joe_b@ example.org"),)),
    ("ask kim.p @example.net for", (("email", "kim.p @example.net"),)),
    ("mail root@localhost or", (("email", "root@localhost"),)),
    ("write to ann@intranet today", (("email", "ann@intranet"),)),
    ("sold 5 @ 3.50 each", ()),
    ("sold 12 @ 20 today", ()),
    ("meet @ noon or", ()),
    ("meet us @ 10.30 or", ()),
    ("thanks @ann_lee for", ()),
    ("a thanks to @joe and @kim.", ()),
    ("see @example.org now", ()),
    ("rows 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 of", ()),
    ("9 8 7 6 5 4 3 2 1 0 1 2 3 4 5 6 7 8 9", ()),
    ("10 20 30 40 50 60 70 80 90 100 110 120", ()),
    ("id 2125550100 was", ()),
    ("isbn 978-3-16-148410-0 is", ()),
    ("about 1 234 567 890 people", ()),
    ("in 12 000 000 000 cells", ()),
    ("on 2024-01-02 2024-01-03 too", ()),
    ("from 1990 1991 1992 on", ()),
    ("sum 123456.789012 and", ()),
    ("build 10.0.19045.3570 of", ()),
    ("ref 1234567890123456 was", ()),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octets(text: str) -> bool:
    """Whether all parts between dots are numbers up to 255; candidates may hold signs and spaces inside a part, which is no number."""
    try:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    except ValueError:
        return False


def _valid(kind: int, text: str) -> bool:
    if kind == 1:
        return octets(text)
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def emails(text: str) -> list[Span]:
    """Leftmost matches of the email pattern: each ``@`` with the run of local characters before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((0, start, found.end()))
            free = found.end()
        else:
            free = at + 1  # no local part goes over an @
        at = text.find("@", free)
    return out


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans ordered by kind and start, and the regions that hold something uncovered."""
    found: list[list[Span]] = [emails(text) if "@" in text else [], [], [], []]
    regions = []
    for run in NUMERIC.finditer(text):
        start, end = run.span()
        if end - start < 7:
            continue
        held = run.group()
        mine = []
        for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
            if (kind == 1 and held.count(".") < 3) or (kind == 3 and "+" not in held):
                continue
            for m in pattern.finditer(text, start, end):
                if _valid(kind, m.group()):
                    mine.append((kind, *m.span()))
        for span in mine:
            found[span[0]].append(span)
        if len(_digits(_uncovered(held, start, mine))) >= 7:
            regions.append((start - (text[start - 1 : start] == "("), end))
    if "@" in text:
        covered = {s[1] + text[s[1] : s[2]].index("@") for s in found[0]}
        ends, at, last = {s[2] for s in found[0]}, text.find("@"), None
        while at >= 0:
            if at not in covered and at not in ends:
                a, b = max(0, at - BEFORE), min(len(text), at + AFTER)
                if last is not None and a < last[1]:
                    last[1] = b
                else:
                    if last:
                        regions.append(tuple(last))
                    last = [a, b]
            at = text.find("@", at + 1)
        if last:
            regions.append(tuple(last))
    return [s for spans in found for s in spans], regions


def _uncovered(held: str, start: int, spans: list[Span]) -> str:
    for _, a, b in spans:
        held = held[: a - start] + " " * (b - a) + held[b - start :]
    return held


def _shape(text: str) -> str:
    """Runs of digits by length, letters as one sign, the rest as it is."""
    return "".join(str(len(t)) if t[0].isdigit() else "a" if t[0].isalpha() else " " if t[0].isspace() else t for t in TOKEN.findall(text))


def _form(kind: int, text: str) -> bool:
    """Whether a span is what the pattern of its type takes."""
    if kind == 0:
        found = emails(text)
        return bool(found) and found[0][1:] == (0, len(text))
    if kind == 1:
        return bool(IP.fullmatch(text)) and octets(text)
    if kind == 2:
        return bool(CARD.fullmatch(text)) and _valid(2, text)
    return bool(PHONE.fullmatch(text)) and _valid(3, text) and text.count("(") == text.count(")")


def _near(kind: int, text: str) -> bool:
    """Whether a span looks like its type without being what its pattern takes."""
    if kind == 0:
        return bool(BROKEN.fullmatch(text))
    return kind == 3 and bool(PLAIN.fullmatch(text)) and _valid(3, text)


def _names(kind: int, text: str, before: str, after: str, cue: str) -> list[str]:
    digits = _digits(text)
    out = [
        "any", f"shape:{_shape(text)}", f"digits:{min(len(digits), 24)}", f"plus:{text[0] == '+'}",
        f"dots:{min(4, text.count('.'))}", f"spaces:{min(4, text.count(' '))}", f"dashes:{min(4, text.count('-'))}",
        f"round:{text.count('(')}{text.count(')')}", f"before:{before}", f"after:{after}", f"cue:{cue}",
        f"form:{_form(kind, text)}", f"near:{_near(kind, text)}",
    ]
    if kind == 2 or kind == 3:
        groups = re.findall("[0-9]+", text)
        out += [f"least:{min(4, min(map(len, groups)))}", f"groups:{min(8, len(groups))}"]
    if kind == 0:
        local, _, domain = text.partition("@")
        host = domain.strip()
        out += [
            f"local:{bool(re.search('[A-Za-z]', local))}", f"host:{bool(re.match('[A-Za-z]', host))}{'.' in host}",
            f"apart:{local[-1:].isspace()}{domain[:1].isspace()}{'.' in host}", f"words:{bool(re.search(r'[^@] [^@]', text))}",
        ]
    if kind == 1:
        out.append(f"octets:{text.count('.') == 3 and octets(text)}")
    if kind == 2:
        out.append(f"luhn:{luhn(digits)}")
    return [f"{KINDS[kind]}|{n}" for n in out]


def _side(c: str) -> str:
    return "edge" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() or c == "_" else "space" if c.isspace() else c


def _index(names: list[str]) -> list[int]:
    return [zlib.crc32(n.encode()) % SIZE for n in names]


@dataclass(frozen=True)
class Lattice:
    """A region's tokens and candidate spans."""

    tokens: list[tuple[int, int]]
    spans: list[tuple[int, int, int]]  # first token, token after the last, kind
    features: np.ndarray  # 0/1, spans by SIZE


def lattice(text: str, start: int, end: int) -> Lattice:
    """Candidates: up to LONGEST characters of a type, no space at their ends, not inside a word or number."""
    tokens = [(start + m.start(), start + m.end()) for m in TOKEN.finditer(text[start:end])]
    spans, rows = [], []
    for i, (a, _) in enumerate(tokens):
        first = text[a]
        if first.isspace() or first in ").-@" or (a and (text[a - 1].isalnum() or text[a - 1] == "_")):
            continue
        marks = letters = 0
        cue = CUE.search(text[max(0, a - 24) : a])
        for j in range(i + 1, len(tokens) + 1):
            c, b = tokens[j - 1]
            marks += text[c] == "@"
            letters += text[c].isalpha()
            spaces = b - a > 2 and len(text[a:b].split()) - 1
            if marks > 1 or spaces > 2 and (letters or marks) or b - a > (LONGEST[0] if letters or marks else max(LONGEST)):
                break
            if b - a > max(LONGEST[1:]) and not marks and "@" not in text[b : a + BEFORE]:
                break
            last, after = text[b - 1], text[b : b + 1]
            if not last.isalnum() or after.isalnum() or after == "_":
                continue
            held = text[a:b]
            n = len(_digits(held))
            kinds = [0] if marks else []
            if n >= 4 and not letters and not marks:
                kinds += [k for k, ok in ((1, held.count(".") == 3), (2, n >= 12), (3, n >= 7)) if ok]
            for kind in kinds:
                if b - a > LONGEST[kind]:
                    continue
                names = _names(kind, held, _side(text[a - 1 : a]), _side(after), cue[1].lower() if cue else "")
                row = np.zeros(SIZE)
                row[_index(names)] = 1
                spans.append((i, j, kind))
                rows.append(row)
    return Lattice(tokens, spans, np.array(rows).reshape(-1, SIZE))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of span features
    moves: np.ndarray  # type before (4: none) by type

    def best(self, lat: Lattice) -> list[tuple[int, int, int]]:
        """Viterbi over segmentations; tokens outside spans score nothing."""
        score = lat.features @ self.weights
        n, top = len(lat.tokens), np.full((len(lat.tokens) + 1, 5), -np.inf)
        top[0, 4] = 0.0
        back: dict[tuple[int, int], tuple] = {}
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _) in enumerate(lat.spans):
            ending[j].append(k)
        for j in range(1, n + 1):
            came = int(top[j - 1].argmax())
            top[j, 4], back[j, 4] = top[j - 1, came], (j - 1, came, None)
            for k in ending[j]:
                i, _, kind = lat.spans[k]
                reach = top[i] + self.moves[:, kind]
                came = int(reach.argmax())
                if reach[came] + score[k] > top[j, kind]:
                    top[j, kind], back[j, kind] = reach[came] + score[k], (i, came, k)
        out, j, kind = [], n, int(top[n].argmax())
        while j:
            i, came, k = back[j, kind]
            if k is not None:
                out.append((lat.spans[k][2], lat.tokens[i][0], lat.tokens[j - 1][1]))
            j, kind = i, came
        return out[::-1]


def _log(values: list[float]) -> float:
    most = max(values, default=-np.inf)
    return most if most == -np.inf else most + float(np.log(np.exp(np.array(values) - most).sum()))


def _posterior(lat: Lattice, score: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the spans, and expected moves, by forward and backward sums over segmentations."""
    n = len(lat.tokens)
    ahead, behind = np.full((n + 1, 5), -np.inf), np.full((n + 1, 5), -np.inf)
    ahead[0, 4], behind[n] = 0.0, 0.0
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j, _) in enumerate(lat.spans):
        starting[i].append(k)
        ending[j].append(k)
    reach = np.full(len(lat.spans), -np.inf)
    for j in range(1, n + 1):
        sums: list[list[float]] = [[], [], [], [], [_log(list(ahead[j - 1]))]]
        for k in ending[j]:
            i, _, kind = lat.spans[k]
            reach[k] = _log(list(ahead[i] + moves[:, kind])) + score[k]
            sums[kind].append(reach[k])
        ahead[j] = [_log(s) for s in sums]
    for i in range(n - 1, -1, -1):
        on = behind[i + 1, 4]
        for before in range(5):
            behind[i, before] = _log([on, *[moves[before, lat.spans[k][2]] + score[k] + behind[lat.spans[k][1], lat.spans[k][2]] for k in starting[i]]])
    total = behind[0, 4]
    held, moved = np.zeros(len(lat.spans)), np.zeros((5, 4))
    for k, (i, j, kind) in enumerate(lat.spans):
        held[k] = np.exp(reach[k] + behind[j, kind] - total)
        moved[:, kind] += np.exp(ahead[i] + moves[:, kind] + score[k] + behind[j, kind] - total)
    return held, moved


def fit(cases: list[tuple[str, list[Span]]], rounds: int = 12, step: float = 0.4, decay: float = 1e-3) -> Model:
    """Gradient ascent on the conditional likelihood of labelled regions ``(text, spans)``."""
    weights, moves = np.zeros(SIZE), np.zeros((5, 4))
    grid, grid_moves = np.full(SIZE, 1e-2), np.full((5, 4), 1e-2)
    ready = []
    for text, spans in cases:
        lat = lattice(text, 0, len(text))
        at = {(kind, lat.tokens[i][0], lat.tokens[j - 1][1]): k for k, (i, j, kind) in enumerate(lat.spans)}
        gold = [at[s] for s in sorted(spans, key=lambda s: s[1]) if s in at]
        if lat.spans and len(gold) == len(spans):
            truth, moved, before, end = np.zeros(len(lat.spans)), np.zeros((5, 4)), 4, 0
            for k in gold:
                i, j, kind = lat.spans[k]
                moved[before if i == end else 4, kind] += 1
                truth[k], before, end = 1, kind, j
            ready.append((lat, truth, moved))
    for _ in range(rounds):
        for lat, truth, moved in ready:
            held, expected = _posterior(lat, lat.features @ weights, moves)
            slope = lat.features.T @ (truth - held) - decay * weights
            grid += slope * slope
            weights += step * slope / np.sqrt(grid)
            slope = moved - expected - decay * moves
            grid_moves += slope * slope
            moves += step * slope / np.sqrt(grid_moves)
    return Model(weights, moves)


def _examples() -> list[tuple[str, list[Span]]]:
    out = []
    for text, spans in EXAMPLES:
        out.append((text, [(KINDS.index(k), text.index(s), text.index(s) + len(s)) for k, s in spans]))
    return out


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of sampled texts with some context, and the base spans in them (kind, start, end flat)."""
    for batch in pieces(batches, "text"):
        texts, spans = [], []
        for text in batch["text"].to_pylist():
            for a, b, held in _labelled(text or ""):
                texts.append((text or "")[a:b])
                spans.append([n for kind, s, e in held for n in (kind, s - a, e - a)])
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.int32()))], names=["region", "spans"])


def _labelled(text: str) -> Iterator[tuple[int, int, list[Span]]]:
    spans, unclear = base_spans(text)
    taken = sorted(spans, key=lambda s: s[1])
    for kind, start, end in taken:
        a, b = max(0, start - 24), min(len(text), end + 8)
        inner = [s for s in taken if s[1] < b and s[2] > a]
        if len(inner) == 1:
            yield a, b, inner
    for start, end in unclear:
        a, b = max(0, start - 24), min(len(text), end + 8, start + 160)
        if not any(s[1] < b and s[2] > a for s in taken) and not any(c == "@" for c in text[a:b]):
            # unlabelled: taken as no personal data if no part of it has the form of some, or nearly
            lat = lattice(text, start, min(end, start + 160))
            held = ((k, text[lat.tokens[i][0] : lat.tokens[j - 1][1]]) for i, j, k in lat.spans)
            if lat.spans and not any(_form(k, t) or _near(k, t) for k, t in held):
                yield a, b, []


def train(docs: DataFrame, text_col: str = "text", sample_texts: int = SAMPLE_TEXTS, sample_regions: int = SAMPLE_REGIONS) -> Model:
    """A model from regions of at most ``sample_texts`` texts, chosen by a hash of the text.

    The texts are thinned by that hash before they are ordered, so what meets
    in one task does not grow with the input.
    """
    text = F.col(text_col)
    rows = docs.select(F.xxhash64(F.lit("pii"), text).alias("turn"), text.alias("text"))
    # among some more texts, those with digits or an @; copies of a text are one
    share = min(1.0, 8 * sample_texts / max(1, docs.count()))
    if share < 1:
        rows = rows.where(F.col("turn") < int(-(2**63) + share * 2**64))
    rows = rows.where(F.col("text").rlike("[0-9]{7}|@|[0-9]\\.[0-9]")).groupBy("turn").agg(F.min("text").alias("text"))
    chosen = rows.orderBy("turn").limit(sample_texts)
    found = stored(chosen.select("text").mapInArrow(_regions, "region string, spans array<int>"), "pii-regions")
    rows = found.orderBy(F.xxhash64("region"), "region").limit(sample_regions).collect()
    cases = _examples()
    cases += [(r.region, [tuple(r.spans[i : i + 3]) for i in range(0, len(r.spans), 3)]) for r in rows]
    singles = [(text[s:e], kind) for text, spans in cases for kind, s, e in spans if kind]
    for (x, k), (y, m) in zip(singles, singles[1:]):  # two values side by side
        cases.append((f"{x} {y}", [(k, 0, len(x)), (m, len(x) + 1, len(x) + 1 + len(y))]))
    for text, spans in cases[len(EXAMPLES) : len(EXAMPLES) + len(rows)]:  # what the patterns no longer take
        if len(spans) == 1:
            kind, a, b = spans[0]
            held = text[a:b]
            bare = re.sub(r"^\+[0-9]{1,3} ", "", held) if kind == 3 else held.replace("@", " @ ") if kind == 0 else held
            if bare != held and _near(kind, bare):
                cases.append((text[:a] + bare + text[b:], [(kind, a, a + len(bare))]))
    return fit(cases)


def find(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """``(base, all)`` spans of a text, ordered by kind and start."""
    base, regions = base_spans(text)
    added = []
    for start, end in regions:
        for a in range(start, end, WINDOW):
            # windows overlap by the longest segment, and one that starts in the overlap is left to the next
            b = min(end, a + WINDOW + max(LONGEST))
            lat = lattice(text, a, b)
            if not lat.spans:
                continue
            for span in model.best(lat):
                kind, s, e = span
                if (s < a + WINDOW or b == end) and not any(x[1] < e and x[2] > s for x in base) and not any(x[1] < e and x[2] > s for x in added):
                    added.append(span)
    return base, sorted(base + added) if added else base


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` per row of ``docs``.

    Counts and ``base_sha256`` are of the base spans; ``spans`` lists all, each
    as ``kind:start:end`` in code points, by kind and start. Base spans of
    different kinds may overlap; added ones overlap nothing. Null text is
    empty and has none. Repeated rows and ids get a row each. Other columns
    are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    small_batches(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # SIZE weights, whatever the input
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            counts, digests, lists = [], [], []
            for text in batch["text"].to_pylist():
                base, every = find(text or "", shipped.value)
                counts.append([sum(s[0] == k for s in base) for k in range(4)])
                digests.append(sha256(joined(base).encode()).hexdigest())
                lists.append(joined(every))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns, pa.array(digests), pa.array(lists)], names=names)

    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
