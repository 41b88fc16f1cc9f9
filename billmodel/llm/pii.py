"""Personal data: a base of patterns, and a character-level BiLSTM-CRF on top.

Base spans are found in the whole text, leftmost and non-overlapping by kind:
e-mail addresses, IPv4 addresses (parts up to 255), card numbers (16 to 19
digits that pass Luhn) and phone numbers (a plus and 8 to 15 digits).

The model is trained here, on the driver, from labelled windows: base spans,
some of them in other common spellings (another separator, no plus, joined to a
number that follows, so that the pattern runs on into it), and windows
with digits or an ``@`` that are no personal data. They are picked kind by kind,
so that harmless digits, however many, leave the others their place: at most
``BOUNDS`` different windows of each, from about ``TRAIN_DOCS`` documents (by a
hash of the text over all rows), and for kinds still short of their bound from
ever more documents, all rows in the end. All kinds hold a digit or an ``@``, so the model reads the
surroundings of these characters, in overlapping windows; where windows overlap
their tag scores are averaged, weighted by the distance to the window's edge, and
one Viterbi pass over the whole stretch reconciles them, around the base spans. A
span of the model is added if it overlaps no base span and is well-formed (a local part and a domain;
a Luhn-valid number of 13 to 19 digits; 7 to 15 digits with a plus or phone
separators).

Defined results: a null text is empty and has no spans; null ids are kept;
repeated rows give repeated results; extra columns are ignored; an empty table
gives an empty result; without any labelled window the model adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billmodel.llm.common import CHUNK, arrow_rows, ship_package
from billmodel.llm.pii_model import CLASSES, KINDS, NEVER, Tagger, classes, spans_of

RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"
WINDOW, STRIDE, REACH = 64, 32, 40
TRAIN_DOCS, TRAIN_WINDOWS, TRAIN_STEPS = 20_000, 2_400, 480
EMAIL, IP, CARD, PHONE, NONE = range(5)
#: Training windows of each kind, and of those that are no personal data.
BOUNDS = {EMAIL: TRAIN_WINDOWS // 4, IP: TRAIN_WINDOWS // 4, CARD: TRAIN_WINDOWS // 4, PHONE: TRAIN_WINDOWS // 4, NONE: TRAIN_WINDOWS // 2}
Span = tuple[int, int, int]

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and not from inside a number: the same matches without retries
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
#: What every text with a base span of a kind has (Java's and Python's syntax).
_HINTS = {EMAIL: r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]+\.[A-Za-z0-9-]", IP: r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", CARD: r"[0-9]([ -]?[0-9]){15}", PHONE: r"\+[0-9]"}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    out: list[Span] = []
    at = text.find("@")
    free = 0  # end of the last match
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((EMAIL, start, m.end()))
            free = m.end()
            at = text.find("@", free)
        else:
            free = at + 1 if start == free else free
            at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return out
    out += [(IP, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((CARD, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append((PHONE, m.start(), m.end()))
    return out


def well_formed(kind: int, text: str) -> bool:
    """Whether a model's span can be what it says."""
    digits = "".join(_DIGIT.findall(text))
    if kind == EMAIL:
        return bool(re.fullmatch(r"[^\s@]+@[^\s@.]+(\.[^\s@.]+)+", text))
    if kind == IP:
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", text)) and all(int(p) <= 255 for p in text.split("."))
    if kind == CARD:
        return bool(re.fullmatch(r"[0-9][0-9 .-]+[0-9]", text)) and 13 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"\+?\(?[0-9][0-9 ()./-]+[0-9]", text)) and 7 <= len(digits) <= 15 and digits != text


# --- training ------------------------------------------------------------------------


def _tags(spans: list[Span], start: int, end: int) -> bytes:
    """Tags of a window; where kinds overlap the first listed wins."""
    out = bytearray(end - start)
    for kind, s, e in reversed(spans):
        for at in range(max(s, start), min(e, end)):
            out[at - start] = 1 + 2 * kind if at == s else 2 + 2 * kind
    return bytes(out)


def _windows(text: str) -> Iterator[tuple[str, bytes]]:
    """Labelled windows around everything that may look like personal data."""
    spans, last = base_spans(text), -WINDOW
    edges = sorted((s, e) for _, s, e in spans)
    by_kind = [[x for x in spans if x[0] == kind] for kind in range(len(KINDS))]
    starts, ends = ([[x[at] for x in some] for some in by_kind] for at in (1, 2))
    for m in _TRIGGER.finditer(text):
        if m.start() < last + STRIDE:
            continue
        last = m.start()
        # a fixed but varied place of the window around its trigger
        start = max(0, last - 8 - (last * 7) % 40)
        cut = bisect_right(edges, (start,)) - 1
        if cut >= 0 and edges[cut][0] < start < edges[cut][1]:
            start = edges[cut][0]  # not from inside a span
        end = min(len(text), start + WINDOW)
        near = [x for some, s, e in zip(by_kind, starts, ends) for x in some[bisect_right(e, start) : bisect_left(s, end)]]
        yield text[start:end], _tags(near, start, end)


class Sample:
    """Different windows by kind: those of least hash, as many as ``bounds`` says.
    Samples of parts add up to the sample of all."""

    def __init__(self, bounds: dict[int, int]):
        self.bounds, self.found = bounds, {kind: {} for kind in bounds}

    def add(self, kind: int, text: str, tags: bytes) -> None:
        if kind not in self.found:
            return
        some = self.found[kind]
        some[text] = min(tags, some.get(text, tags))
        if len(some) > 4 * self.bounds[kind]:
            self.cut(kind)

    def cut(self, kind: int) -> None:
        some = self.found[kind]
        self.found[kind] = {t: some[t] for t in sorted(some, key=_spot)[: self.bounds[kind]]}

    def rows(self) -> list[tuple[int, str, bytes]]:
        for kind in self.bounds:
            self.cut(kind)
        return [(kind, t, tags) for kind, some in self.found.items() for t, tags in some.items()]


def _spot(text: str) -> tuple[bytes, str]:
    return hashlib.blake2b(text.encode(), digest_size=8).digest(), text


SAMPLE = "kind int, text string, tags binary"


def _sampled(bounds: dict[int, int]):
    """The sample of the texts of a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sample(bounds)
        for batch in batches:
            for t in batch.column(0):
                for window, tags in _windows(t.as_py()):
                    for kind in {(tag - 1) // 2 for tag in set(tags) if tag} or {NONE}:
                        sample.add(kind, window, tags)
        yield from arrow_rows(SAMPLE, sample.rows()).to_batches()

    return run


def _merged(bounds: dict[int, int]):
    """The sample of samples."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sample(bounds)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                sample.add(*row)
        yield from arrow_rows(SAMPLE, sample.rows()).to_batches()

    return run


def training_windows(docs: DataFrame, text_col: str, train_docs: int) -> list[tuple[str, bytes]]:
    """Windows and tags to train on, kinds in turn; see the module's text."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(text.alias("text"))
    spot, spots = F.pmod(F.xxhash64("text"), F.lit(1_000_003)), 1_000_003
    low, high = 0, max(1, int(min(1.0, train_docs / max(1, docs.count())) * spots))
    sample, short, hint = Sample(BOUNDS), list(BOUNDS), "[0-9@]"
    while True:
        bounds = {kind: BOUNDS[kind] for kind in short}
        some = rows.filter(F.col("text").rlike(hint))
        if (low, high) != (0, spots):
            some = some.filter((spot >= low) & (spot < high))
        # two steps, so that the driver gets a few samples whatever the parts
        parts = some.mapInArrow(_sampled(bounds), SAMPLE).repartition(8, "text").mapInArrow(_merged(bounds), SAMPLE)
        for r in parts.collect():
            sample.add(r["kind"], r["text"], bytes(r["tags"]))
        short = [kind for kind in range(len(KINDS)) if len(sample.found[kind]) < BOUNDS[kind]]
        if not short or high == spots:
            break
        low, high = high, min(spots, 8 * high)
        hint = "|".join(_HINTS[kind] for kind in short)
    out: dict[str, bytes] = {}
    for _, window, tags in sample.rows():
        out[window] = min(tags, out.get(window, tags))
    return sorted(out.items(), key=lambda x: _spot(x[0]))


def _respelled(text: str, tags: np.ndarray, n: int) -> tuple[str, np.ndarray] | None:
    """The window with its phone numbers or cards in another spelling."""
    kinds = (tags - 1) // 2
    chars, keep, changed = list(text), np.ones(len(text), bool), False
    for at, ch in enumerate(text):
        if tags[at] and kinds[at] == PHONE:
            if ch == "+" and n % 2:
                keep[at], changed = False, True
                if at + 1 < len(text):
                    tags[at + 1] = 1 + 2 * PHONE
            elif ch in "()" and n % 4 < 2:  # (555) 01 as 555-01
                keep[at], changed = False, True
                if ch == ")" and at + 1 < len(text) and text[at + 1] == " ":
                    chars[at + 1] = "-"
            elif ch in " -" and n % 3 == 1:
                chars[at], changed = ".", True
        elif tags[at] and kinds[at] == CARD and ch == " " and n % 3 == 2:
            chars[at], changed = "-", True
    if not changed:
        return None
    return "".join(c for c, k in zip(chars, keep) if k), tags[keep]


def _joined(examples: list[tuple[str, np.ndarray]]) -> list[tuple[str, np.ndarray]]:
    """Numbers that follow each other, a space apart: a phone number and, in turn,
    an address, a card, another phone number or a plain number (no span)."""
    def spans(n: int) -> list[Span]:
        return spans_of(examples[n][1])

    phones = [n for n in range(len(examples)) if any(k == PHONE for k, _, _ in spans(n))]
    others = [(n, x) for n in range(len(examples)) for x in spans(n) if x[0] != EMAIL]
    out = []
    for i, n in enumerate(phones):
        text, tags = examples[n]
        _, start, end = next(x for x in spans(n) if x[0] == PHONE)
        m, (kind, s, e) = others[i * 7 % len(others)]
        more, more_tags = examples[m][0][s:e], examples[m][1][s:e]
        if i % 4 == 3:
            more, more_tags = str(10 ** (i % 5) * (3 + i % 7)), np.zeros(i % 5 + 1, np.int64)
        first = max(0, start - (i * 5) % 24)
        joined = text[first:end] + " " + more + text[end:]
        labels = np.concatenate([tags[first:end], [0], more_tags, tags[end:]])
        if end - first + 1 + len(more) <= WINDOW:
            out.append((joined[:WINDOW], labels[:WINDOW]))
    return out


def train(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> Tagger | None:
    """A model fitted on labelled windows of about ``train_docs`` documents, more
    where these don't have enough of a kind; None without any labelled window."""
    ship_package(docs.sparkSession)
    examples = [(s, np.frombuffer(t, np.uint8).astype(np.int64)) for s, t in training_windows(docs, text_col, train_docs)]
    if not any(t.any() for _, t in examples):
        return None
    joined = _joined(examples)
    examples += [x for n, (s, t) in enumerate(examples + joined) for m in (n, n + 5) if t.any() and (x := _respelled(s, t.copy(), m))] + joined
    chars = np.full((len(examples), WINDOW), CLASSES, np.int64)
    tags = np.zeros((len(examples), WINDOW), np.int64)
    for r, (s, t) in enumerate(examples):
        chars[r, : len(s)], tags[r, : len(s)] = classes(s), t
    model = Tagger()
    model.fit(chars, tags, TRAIN_STEPS)
    return model


# --- search ----------------------------------------------------------------------------


def stretches(text: str) -> list[tuple[int, int]]:
    """Surroundings of digits and ``@``, joined where they meet."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        s, e = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and s <= out[-1][1]:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _merged_edges(spans: list[Span]) -> list[tuple[int, int]]:
    """What the spans cover, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


#: Weight of a window's positions: less towards the edges, where context is cut.
_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def model_spans(model: Tagger, texts: list[str], taken: list[list[Span]] | None = None) -> list[list[Span]]:
    """Spans that the model sees in each text, windows reconciled. What is
    ``taken`` lies outside its spans: the path goes around it, so that a number
    that runs on into a known one still ends where that begins."""
    places = [(d, s, e) for d, text in enumerate(texts) for s, e in stretches(text)]
    edges = [_merged_edges(x) for x in taken] if taken else []
    ends = [[b for _, b in x] for x in edges]
    out: list[list[Span]] = [[] for _ in texts]
    step = 1024  # stretches at once
    for first in range(0, len(places), step):
        some = places[first : first + step]
        sums = [np.zeros((e - s, model.bias.size), np.float32) for _, s, e in some]
        weights = [np.zeros((e - s, 1), np.float32) for _, s, e in some]
        rows, of = [], []

        def score() -> None:
            scores = model.emissions(np.stack(rows)) * _WEIGHT[:, None]
            for (n, at, size), x in zip(of, scores):
                sums[n][at : at + size] += x[:size]
                weights[n][at : at + size, 0] += _WEIGHT[:size]

        for n, (d, s, e) in enumerate(some):
            chars = classes(texts[d][s:e])
            starts = [*range(0, max(1, len(chars) - WINDOW), STRIDE), max(0, len(chars) - WINDOW)]
            for at in dict.fromkeys(starts):
                row = np.full(WINDOW, CLASSES, np.int64)
                cut = chars[at : at + WINDOW]
                row[: len(cut)] = cut
                rows.append(row)
                of.append((n, at, len(cut)))
                if len(rows) == 2048:
                    score()
                    rows, of = [], []
        if rows:
            score()
        for (d, s, e), x, w in zip(some, sums, weights):
            x /= w
            for a, b in edges[d][bisect_left(ends[d], s + 1) :] if taken else ():
                if a >= e:
                    break
                x[max(a - s, 0) : b - s, 1:] = NEVER
        for (d, s, _), tags in zip(some, model.decode(sums)):
            out[d] += [(k, s + a, s + b) for k, a, b in spans_of(tags)]
    return out


def find_spans(texts: list[str], model: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text, by kind and start."""
    marked = [d for d, text in enumerate(texts) if _TRIGGER.search(text)]
    base = {d: base_spans(texts[d]) for d in marked}
    out: list[tuple[list[Span], list[Span]]] = [([], []) for _ in texts]
    seen = model_spans(model, [texts[d] for d in marked], [base[d] for d in marked]) if model and marked else [[] for _ in marked]
    for d, more in zip(marked, seen):
        taken = sorted((s, e) for _, s, e in base[d])
        starts = [s for s, _ in taken]
        furthest = np.maximum.accumulate([e for _, e in taken]) if taken else []
        added = []
        for kind, s, e in more:
            at = bisect_right(starts, e - 1)
            if not (at and furthest[at - 1] > s) and well_formed(kind, texts[d][s:e]):
                added.append((kind, s, e))
        out[d] = (base[d], sorted(base[d] + added))
    return out


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are one."""
    out, end = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= end:
            out += [text[end:s], f"<{KINDS[k]}>"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def _search(model: Tagger | None, with_masked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0

            def rows(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
                out = []
                for i, text, (base, every) in zip(ids, texts, find_spans(texts, model)):
                    counts = [sum(k == kind for k, _, _ in base) for kind in range(len(KINDS))]
                    out.append((i, *counts, hashlib.sha256(spelled(base).encode()).hexdigest(), spelled(every),
                                masked(text, every) if with_masked else None))
                return iter(arrow_rows(RESULT, out).to_batches())

            for i, t in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(t.as_py() or "")
                held += len(texts[-1])
                if held >= CHUNK:
                    yield from rows(ids, texts)
                    ids, texts, held = [], [], 0
            yield from rows(ids, texts)

    return run


def pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_masked: bool = False, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, masked): the
    counts and the digest are of base spans, ``spans`` has all (kind:start:end in
    code points, end exclusive); ``masked`` is null unless ``with_masked``."""
    model = train(docs, text_col, train_docs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
    return rows.mapInArrow(_search(model, with_masked), RESULT)


def mask_texts(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``docs`` with all spans of its texts masked; a null text stays null."""
    model = train(docs, text_col, train_docs)

    def run(column: pa.Array) -> pa.Array:
        out: list[str | None] = []
        texts, held = [], 0

        def flush() -> None:
            out.extend(None if t is None else masked(t, every) for t, (_, every) in zip(texts, find_spans([t or "" for t in texts], model)))

        for t in column:
            texts.append(t.as_py())
            held += len(texts[-1] or "")
            if held >= CHUNK:
                flush()
                texts, held = [], 0
        flush()
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, F.arrow_udf(run, "string").asNondeterministic()(F.col(f"`{text_col}`").cast("string")))
