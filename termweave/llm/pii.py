"""Operator 2: personal data by fixed patterns and a linear-chain conditional random field.

Base spans come from the patterns of each kind, leftmost and non-overlapping; a match that fails
its check (address parts, card digits, number of digits) is dropped without another try. The
random field adds spans the patterns miss: it labels the words of every line by their shape
(letters, digits and signs, with runs shortened), with features of the word and of its two
neighbours. It is trained from a small labelled table: words of a bounded sample of documents,
labelled by the base spans on them, and the same words with disguises that keep the label (other separators,
a spelled-out at sign). Decoding is exact Viterbi over all lines of a batch at once, in numpy.

Null texts count as empty; they have no span. Base spans are kept as they are; an added span that
touches a base span is left out. Positions are code points, ends exclusive. Ties between labels go to the first in LABELS.
Repeated rows and very long texts are read in full like any other; extra columns are not read. Without training
words the field labels nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termweave.llm import arrays

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
# The patterns of the base spans.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# Documents with base spans from which the labelled table is made, and words about each span.
TRAINING_TEXTS = 400
CONTEXT_WORDS = 6
_DIGIT_RUNS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else (2 * digit - 9 if digit > 4 else 2 * digit)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))
    digits = "".join(_DIGIT_RUNS.findall(found))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def plausible(kind: str, found: str) -> bool:
    """Whether an added span passes the check of its kind, however it is written."""
    runs = _DIGIT_RUNS.findall(found)
    digits = "".join(runs)
    if kind == "email":
        return "@" in found or "at" in found.lower()
    if kind == "ip":
        return len(runs) == 4 and passes("ip", ".".join(runs))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def email_matches(text: str) -> Iterator[re.Match]:
    """The matches of the address pattern; it is tried only from the start of the run of characters before an at sign.

    A match holds one at sign that follows a run of local characters, and the leftmost match starts
    at the run's start or, if that lies in the match before, at that match's end.
    """
    pattern, done, at = PATTERNS["email"], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and text[start - 1].isalnum() or text[start - 1] in "._%+-"):
            start -= 1
        found = pattern.match(text, start) if start < at else None
        if found:
            yield found
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and start."""
    out = []
    for kind in KINDS:
        if kind == "email":
            matches = email_matches(text)
        elif kind == "phone" and "+" not in text:
            continue
        else:
            matches = PATTERNS[kind].finditer(text)
        out += [(kind, m.start(), m.end()) for m in matches if passes(kind, m.group())]
    return out


# Word shapes. Characters fall into classes; a run of letters stands as one, of digits as one of four lengths.
_OTHER = 15
_CODE = np.full(0x100, _OTHER, np.uint8)
for _chars, _value in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3), ("@", 5), (".", 6), ("-", 7), ("+", 8), ("(", 9), (")", 10), ("_", 11), ("%", 12), (":", 13), ("/", 14)):
    for _char in _chars:
        _CODE[ord(_char)] = _value
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_SHAPES = 1 << 14


def shapes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, shape, line start) of every word in the bytes of texts.

    A shape is a hashed number below _SHAPES; words of one bare run of letters all have the
    few shapes of that. Bytes of other characters count as letters.
    """
    starts, ends = arrays.runs(~_SPACES[data], bounds)
    code = _CODE[data].copy()
    code[data >= 0x80] = 1
    code[data == 0x0A] = 0
    changed = np.ones(data.size, bool)
    changed[1:] = code[1:] != code[:-1]
    changed[starts] = True
    heads = np.flatnonzero(changed)
    sizes = np.diff(np.append(heads, data.size))
    value = code[heads].astype(np.uint64)
    digits = value == 3
    value[digits] += np.uint64(20) * np.minimum(sizes[digits], 13).astype(np.uint64)
    firsts = np.searchsorted(heads, starts)
    lasts = np.searchsorted(heads, ends)
    # Runs beyond the twelfth of a word count no more: the shape of a long word is that of its head.
    hashes = arrays.span_hashes(arrays.mix(value), firsts, np.minimum(lasts, firsts + 12))
    shape = (hashes % np.uint64(_SHAPES)).astype(np.int64)
    newline = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line = np.ones(starts.size, bool)
    line[1:] = newline[starts[1:]] != newline[ends[:-1]]
    edges = np.searchsorted(starts, bounds[:-1])
    line[edges[edges < starts.size]] = True
    return starts, ends, shape, line


class Field:
    """Linear-chain conditional random field: weights by shape of a word and of its neighbours, and by label pairs."""

    def __init__(self) -> None:
        n = len(LABELS)
        self.own, self.before, self.after = (np.zeros((_SHAPES, n)) for _ in range(3))
        self.step = np.zeros((n, n))
        # Shapes of the labelled table, and those of its personal data; a word of no such shape is none.
        self.seen, self.positive = np.zeros((2, _SHAPES), bool)

    def emissions(self, shape: np.ndarray, line: np.ndarray) -> np.ndarray:
        out = self.own[shape]
        inner = ~line[1:]
        out[1:][inner] += self.before[shape[:-1][inner]]
        out[:-1][inner] += self.after[shape[1:][inner]]
        out[~self.positive[shape], 1:] = -1e6
        return out

    def train(self, rows: list[tuple[np.ndarray, np.ndarray]], turns: int = 60, rate: float = 0.3, decay: float = 1e-3) -> None:
        """Gradient ascent on the likelihood of labelled lines (shapes, labels), all lines at once."""
        if not rows:
            return
        n, longest = len(LABELS), max(len(shape) for shape, _ in rows)
        shape, label, used = np.zeros((3, len(rows), longest), np.int64)
        for k, (own, labels) in enumerate(rows):
            shape[k, : own.size], label[k, : own.size], used[k, : own.size] = own, labels, 1
        mask = used.astype(bool)
        last = mask.sum(1) - 1
        every = np.arange(len(rows))
        self.seen[shape[mask]] = True
        self.positive[shape[mask & (label > 0)]] = True
        both = mask[:, 1:]
        weights = (self.own, self.before, self.after, self.step)
        squares = [np.full_like(w, 1e-6) for w in weights]
        gold = np.eye(n)[label]
        for _ in range(turns):
            emit = self.own[shape]
            emit[:, 1:] += self.before[shape[:, :-1]] * both[..., None]
            emit[:, :-1] += self.after[shape[:, 1:]] * both[..., None]
            forward, backward = emit.copy(), np.zeros_like(emit)
            for k in range(1, longest):
                part = forward[:, k - 1, :, None] + self.step
                forward[:, k] += np.logaddexp.reduce(part, 1)
            for k in range(longest - 2, -1, -1):
                part = self.step + (emit[:, k + 1] + backward[:, k + 1])[:, None, :]
                backward[:, k] = np.logaddexp.reduce(part, 2) * mask[:, k + 1, None]
            total = np.logaddexp.reduce(forward[every, last], 1)
            slope = (gold - np.exp(np.minimum(forward + backward - total[:, None, None], 0))) * mask[..., None]
            slopes = [np.zeros_like(w) for w in weights]
            np.add.at(slopes[0], shape[mask], slope[mask])
            np.add.at(slopes[1], shape[:, :-1][both], slope[:, 1:][both])
            np.add.at(slopes[2], shape[:, 1:][both], slope[:, :-1][both])
            for k in range(1, longest):
                live = mask[:, k]
                pair = forward[live, k - 1][:, :, None] + self.step + (emit[live, k] + backward[live, k])[:, None, :]
                slopes[3] -= np.exp(np.minimum(pair - total[live, None, None], 0)).sum(0)
                np.add.at(slopes[3], (label[live, k - 1], label[live, k]), 1)
            for weight, slope, square in zip(weights, slopes, squares, strict=True):
                slope -= decay * len(rows) * weight
                square += slope * slope
                weight += rate * slope / np.sqrt(square)

    def decode(self, shape: np.ndarray, line: np.ndarray) -> np.ndarray:
        """The best label of every word: Viterbi, one step for all lines that are long enough.

        A line in which no word has a shape of personal data is `none` throughout and needs no step.
        """
        labels = np.zeros(shape.size, np.int64)
        if not shape.size or not self.positive.any():
            return labels
        begins = np.flatnonzero(line)
        may = np.add.reduceat(self.positive[shape].astype(np.int64), begins) > 0
        sizes = np.diff(np.append(begins, shape.size))
        begins, sizes = begins[may], sizes[may]
        if not begins.size:
            return labels
        emit = self.emissions(shape, line)
        order = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[order], sizes[order]
        score = emit[begins]
        back = np.zeros(shape.size * len(LABELS), np.int8).reshape(shape.size, -1)
        ends = np.zeros((begins.size, len(LABELS)))
        for k in range(1, int(sizes[0])):
            n = int(np.searchsorted(-sizes, -k, "left"))  # lines longer than k
            ends[n : len(score)] = score[n:]
            part = score[:n, :, None] + self.step[None]
            came = part.argmax(1)
            back[begins[:n] + k] = came
            score = np.take_along_axis(part, came[:, None], 1)[:, 0] + emit[begins[:n] + k]
        ends[: len(score)] = score
        label = ends.argmax(1)
        for k in range(int(sizes[0]) - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -k, "left"))
            at = begins[:n] + k
            labels[at] = label[:n]
            label[:n] = back[at, label[:n]]
        return labels


def disguises(kind: str, text: str) -> list[str]:
    """The same data written in ways the patterns do not take."""
    if kind == "email":
        return [text.replace("@", "(at)"), text.replace("@", "[at]"), text.replace("@", "(at)").replace(".", "(dot)")]
    if kind == "ip":
        return [text.replace(".", "-"), text.replace(".", "[.]")]
    if kind == "card":
        digits = "".join(_DIGIT_RUNS.findall(text))
        return [".".join(digits[k : k + 4] for k in range(0, len(digits), 4)), "_".join(digits[k : k + 4] for k in range(0, len(digits), 4))]
    return [text.replace("+", "00"), text.replace("+", "(+") + ")"]


def label_words(text: str, spans: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shape, label, line start) of the words of a text; a word that a span touches has its label."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, shape, line = shapes(data, np.array([0, data.size]))
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    label = np.zeros(starts.size, np.int64)
    for kind, a, b in spans:
        low, high = heads[a], heads[b] if b < heads.size else data.size
        label[(starts < high) & (ends > low)] = LABELS.index(kind)
    return shape, label, line


def labelled_table(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = TRAINING_TEXTS) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans) of short passages: the base spans of at most n documents, the lowest by hash, and their disguises."""
    likely = F.col(text).rlike(r"@|[0-9]{3}")
    # The ids are chosen first, so that no task sends more texts than those.
    ids = docs.where(likely & F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.xxhash64(key, text).alias("h")).orderBy("h", "_id").limit(n)
    chosen = docs.where(likely).select(F.col(key).alias("_key"), F.col(text).alias("text"))
    rows = chosen.join(F.broadcast(ids.select("_id")), F.col("_key") == F.col("_id"), "left_semi").toPandas().sort_values(["_key", "text"])["text"]
    out = []
    for full in rows:
        for kind, a, b in base_spans(full):
            left = " ".join(full[max(0, a - 200) : a].split(" ")[-CONTEXT_WORDS:])
            right = " ".join(full[b : b + 200].split(" ")[:CONTEXT_WORDS])
            for form in [full[a:b], *disguises(kind, full[a:b])]:
                out.append((left + form + right, [(kind, len(left), len(left) + len(form))]))
        words = [w for w in full.split() if not any(c.isdigit() for c in w)][:16]
        out.append((" ".join(words), []))
    return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    field = Field()
    rows: dict[tuple[bytes, bytes], tuple[np.ndarray, np.ndarray]] = {}
    for passage, spans in labelled_table(docs, key, text):
        shape, label, line = label_words(passage, spans)
        cuts = np.append(np.flatnonzero(line), shape.size)
        # Lines that look alike count once.
        rows |= {(shape[a:b].tobytes(), label[a:b].tobytes()): (shape[a:b], label[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a}
    field.train(list(rows.values()))
    return field


def added_spans(field: Field, raw: bytes, base: list[list[tuple[str, int, int]]], bounds: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Spans of the field for each text of a chunk, without those that touch a base span."""
    data = np.frombuffer(raw, np.uint8)
    out: list[list[tuple[str, int, int]]] = [[] for _ in base]
    if not data.size:
        return out
    starts, ends, shape, line = shapes(data, bounds)
    labels = field.decode(shape, line)
    at = np.flatnonzero(labels)
    if not at.size:
        return out
    # Words in a row with one label are one span.
    new = np.ones(at.size, bool)
    new[1:] = (np.diff(at) > 1) | (labels[at[1:]] != labels[at[:-1]]) | line[at[1:]]
    heads = np.flatnonzero(new)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    trim = re.compile(rb"[A-Za-z0-9+(](?:.*[A-Za-z0-9)])?", re.S)
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), at.size], strict=True):
        kind = LABELS[labels[at[a]]]
        words = [(int(starts[w]), int(ends[w])) for w in at[a:b]]
        # All words of a label together, or else each by itself.
        for low, high in [(words[0][0], words[-1][1]), *(words if len(words) > 1 else [])]:
            core = trim.search(raw[low:high])
            if core is None or not plausible(kind, core.group().decode("utf-8", "replace")):
                continue
            low, high = low + core.start(), low + core.end()
            k = int(np.searchsorted(bounds, low, "right")) - 1
            first = chars[bounds[k]]
            start, end = int(chars[low] - first), int(chars[high] - first)
            if all(end <= s or start >= e for _, s, e in [*base[k], *out[k]]):
                out[k].append((kind, start, end))
    return out


def find_spans(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """(key, keep..., base, added) of every row; both are lists of (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kept = [docs.schema[c] for c in (key, *keep)]
    span = "ARRAY<STRUCT<kind: STRING, start: LONG, end: LONG>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", base {span}, added {span}"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def as_column(spans: list[list[tuple[str, int, int]]]) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in spans], kind)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base: list[list[tuple[str, int, int]]] = []
            added: list[list[tuple[str, int, int]]] = []
            for _, data, bounds in arrays.chunks(batch.column(batch.num_columns - 1)):
                raw = data.tobytes()
                here = [base_spans(raw[a:b].decode("utf-8", "replace")) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                base += here
                added += added_spans(shared.value, raw, here, bounds)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)] + [as_column(base), as_column(added)]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in kept] + ["base", "added"])

    return docs.select(key, *keep, F.col(text).alias("_text")).mapInArrow(read, schema)


def digest_columns(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of found spans."""
    order = F.array(*(F.lit(k) for k in KINDS))

    def spelled(column: Column) -> Column:
        ranked = F.transform(column, lambda s: F.struct(F.array_position(order, s.kind).alias("rank"), s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind")))
        return F.array_join(F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in KINDS]
    both = F.concat("base", "added")
    return found.select(key, *counts, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(both).alias("spans"), F.size("added").cast("long").alias("n_added"))


def mask(docs: DataFrame, field: Field, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """`docs` with every span of personal data replaced by its kind in angle brackets; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index(text)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            texts: list[str | None] = []
            for first, data, bounds in arrays.chunks(column):
                raw = data.tobytes()
                whole = [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                base = [base_spans(t) for t in whole]
                for k, (t, old, new) in enumerate(zip(whole, base, added_spans(shared.value, raw, base, bounds), strict=True)):
                    if not column[first + k].is_valid:
                        texts.append(None)
                        continue
                    parts, done = [], 0
                    for kind, a, b in sorted(old + new, key=lambda s: (s[1], s[2])):
                        if a >= done:
                            parts += [t[done:a], f"<{kind}>"]
                        done = max(done, b)
                    texts.append("".join([*parts, t[done:]]) if parts else t)
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(read, docs.schema)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in docs.columns else out
