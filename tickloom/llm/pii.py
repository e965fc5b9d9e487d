"""Personal data: fixed patterns, and a linear-chain conditional random field.

The patterns find what is written in the usual forms. The field labels tokens by their
shapes and their neighbours', is trained from a small table of labelled lines, and is
decoded by Viterbi for all token sequences of a batch at once; what it finds beyond the
patterns (other separators, spelled-out signs) is kept if it reads as such data.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.ragged import flat, pieces

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{b}-{k}" for k in KINDS for b in "BI"))
#: Tokens on either side of one with a digit or an at sign that are labelled with it.
MARGIN = 2
#: Cells of a padded batch of sequences that are decoded together.
DECODED = 1 << 18

#: The labelled table: made-up lines in which tags mark personal data.
LABELLED = (
    "call me at <phone>(415) 555-0132</phone> tomorrow",
    "phone: <phone>415-555-0132</phone> or write",
    "tel <phone>415.555.0132</phone> after noon",
    "reach us on <phone>+1 (415) 555-0132</phone> any day",
    "fax <phone>(212) 555 0188</phone> please",
    "the number is <phone>212-555-0188</phone>",
    "cell: <phone>(646) 555-0147</phone>, evenings",
    "telefon <phone>030/5550-1234</phone> oder post",
    "appelez le <phone>01.55.50.12.34</phone> demain",
    "llame al <phone>+34 915 550 123</phone> hoy",
    "ring <phone>020 7946 0123</phone> now",
    "dial <phone>00 44 20 7946 0123</phone> from abroad",
    "write to <email>jane.doe@mail.example.com</email> soon",
    "email <email>j_smith@example.org</email> or call",
    "contact <email>jane (at) example (dot) com</email> please",
    "mail: <email>bob [at] example [dot] org</email> thanks",
    "mail <email>bob[at]example.org</email> thanks",
    "email <email>ann(at)example.net</email> today",
    "from <email>info@example.net</email>, we hope",
    "mail <email>carl (at) company (dot) com</email> first",
    "or <email>office (at) town (dot) net</email> instead",
    "is <email>mary.poe (at) house (dot) org</email> and",
    "try <email>sam [at] river [dot] com</email> next",
    "server <ip>192.168.10.4</ip> answered",
    "host at <ip>10.0.0.255</ip> failed",
    "blocked <ip>203[.]0[.]113[.]7</ip> again",
    "from ip <ip>198.51.100.23</ip> port closed",
    "address <ip>203[.]0[.]113[.]99</ip> was seen",
    "the <ip>10[.]2[.]0[.]1</ip> host",
    "ip <ip>172[.]16[.]31[.]8</ip> found",
    "card <card>4111 1111 1111 1111</card> expires",
    "paid with <card>4111-1111-1111-1111</card> today",
    "card number <card>5500000000000004</card> was used",
    "visa <card>4111.1111.1111.1111</card> valid",
    "amex <card>3400 000000 00009</card> accepted",
    "charge <card>5500/0000/0000/0004</card> now",
    "on 2024-01-15 we met at 10:30 again",
    "born 15.01.1987 in the north",
    "between 1990-2005 it grew by 12.5 percent",
    "version 2.10.3.1 was released in 2021",
    "order 20240115-00042 was shipped on 01/17/2024",
    "isbn 978-3-16-148410-0 is out of print",
    "it cost 1,250.00 euros or 1.250,00 there",
    "chapter 12 page 345 line 6 and 7",
    "from 1914 to 1918 and 1939 to 1945",
    "the score was 3-2 then 10-9 in round 21",
    "call 3 of 12 took 4500 seconds",
    "serial 00481-22713-99120-44123 on the box",
    "at 5 pm 1000 people and 250000 more",
    "id 4845168114407329 in row 9807915762",
    "token = a81bc81b4e5d4e5d and 04dbebab91ab",
    "| 12 | 345 | 6789 | total 7146",
    "see @handle and 24/7 help @ the desk",
    "width 1024x768 ratio 16:9 scale 1:50000",
    "room 101 floor 3 phone booth 7",
    "lat 52.5200 lon 13.4050 height 34",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9.]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_ACTIVE = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]", re.IGNORECASE)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Matches of the address pattern, without trying every start of a long run."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield 0, start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _addresses(text: str) -> Iterator[Span]:
    """Four numbers joined by dots, leftmost first; parts over 255 are dropped."""
    for run in _NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, at = [], run.start()
        for part in run.group().split("."):
            parts.append((at, part))
            at += len(part) + 1
        first = 0
        while first + 4 <= len(parts):
            four = parts[first : first + 4]
            if not all(part for _, part in four):
                first += 1
                continue
            # Zeros ahead of a number may be many: they are cut off before it is read.
            if all(len(own := part.lstrip("0")) <= 3 and int(own or "0") <= 255 for _, part in four):
                yield 1, four[0][0], four[3][0] + len(four[3][1])
            first += 4


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of all pattern matches, by kind, then start."""
    spans = list(_emails(text)) if "@" in text else []
    spans += _addresses(text)
    for found in _CARD.finditer(text):
        digits = re.sub("[ -]", "", found.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in found.group()) <= 15:
                spans.append((3, found.start(), found.end()))
    return spans


def _reads_as(kind: int, text: str) -> bool:
    """Whether what the field found is well formed, its signs spelled out or not."""
    plain = re.sub(r"\s*[\[(]\s*at\s*[\])]\s*", "@", text, flags=re.IGNORECASE)
    plain = re.sub(r"\s*[\[(]\s*(?:dot|\.)\s*[\])]\s*", ".", plain, flags=re.IGNORECASE)
    digits = re.sub("[^0-9]", "", plain)
    if kind == 0:
        return _EMAIL.fullmatch(plain) is not None
    if kind == 1:
        return re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", plain) is not None and max(map(int, plain.split("."))) <= 255
    if kind == 2:
        return re.fullmatch(r"[0-9]+(?:[ ./_-][0-9]+)+", plain) is not None and 13 <= len(digits) <= 19 and luhn(digits)
    groups = re.findall("[0-9]+", plain)
    shaped = re.fullmatch(r"\+?\(?[0-9][0-9 ()./-]*[0-9]", plain) is not None
    return shaped and 9 <= len(digits) <= 15 and 3 <= len(groups) <= 7 and max(map(len, groups)) <= 5


def _shape(token: str) -> tuple[str, ...]:
    """Features of a token: its shape in detail, in outline, and as a known word."""
    fine = re.sub("[A-Za-z]+", "a", re.sub(r"[^\x00-\x7F]+", "a", token))
    fine = re.sub("[0-9]", "9", fine)[:24]
    coarse = re.sub("9+", "9", fine)
    n_digits = sum(c in "0123456789" for c in token)
    word = token.lower().strip(".,:;!?()[]")[:12]
    return (f"f {fine}", f"c {coarse}", f"n {min(n_digits, 20)}", f"w {word if not n_digits else ''}", f"@ {'@' in token}")


class Field:
    """Weights of a linear-chain field: features by label, and label by next label."""

    def __init__(self, rows: tuple[str, ...] = LABELLED, sweeps: int = 200):
        tokens, labels = zip(*map(self._labelled, rows))
        self.number: dict[str, int] = {}
        for line in tokens:
            for at in range(len(line)):
                for name in self._names(line, at):
                    self.number.setdefault(name, len(self.number))
        n, width = len(rows), max(map(len, tokens))
        seen = np.zeros((n, width, len(self.number)), np.float32)
        gold, held = np.zeros((n, width), np.int64), np.zeros((n, width), bool)
        for row, line in enumerate(tokens):
            for at in range(len(line)):
                seen[row, at, [self.number[name] for name in self._names(line, at)]] = 1
                gold[row, at], held[row, at] = labels[row][at], True
        size = len(LABELS)
        self.weights = np.zeros((len(self.number), size))
        self.next = np.zeros((size, size))
        # An inside label follows only a label of its own kind.
        self.barred = np.zeros((size, size))
        for b, name in enumerate(LABELS):
            if name[0] == "I":
                self.barred[:, b] = [0 if other[1:] == name[1:] else -1e4 for other in LABELS]
        self.opening = np.array([-1e4 if name[0] == "I" else 0.0 for name in LABELS])
        moments = [np.zeros_like(w) for w in (self.weights, self.weights, self.next, self.next)]
        for sweep in range(1, sweeps + 1):
            slopes = self._slopes(seen, gold, held)
            for weights, slope, first, second in ((self.weights, slopes[0], *moments[:2]), (self.next, slopes[1], *moments[2:])):
                first += 0.1 * (slope - first)
                second += 0.01 * (slope**2 - second)
                weights += 0.1 * (first / (1 - 0.9**sweep)) / (np.sqrt(second / (1 - 0.99**sweep)) + 1e-8)
        self.known: dict[tuple[str, str], np.ndarray] = {}

    @staticmethod
    def _labelled(row: str) -> tuple[list[str], list[int]]:
        tokens, labels = [], []
        for part in re.split(r"(<(\w+)>.*?</\2>)", row):
            if part in KINDS:
                continue
            tag = re.fullmatch(r"<(\w+)>(.*)</\w+>", part)
            for place, token in enumerate((tag[2] if tag else part).split()):
                tokens.append(token)
                labels.append(LABELS.index(f"{'I' if place else 'B'}-{tag[1]}") if tag else 0)
        return tokens, labels

    @staticmethod
    def _names(line: list[str], at: int) -> list[str]:
        names = [f"own {s}" for s in _shape(line[at])]
        names += [f"before {s}" for s in (_shape(line[at - 1]) if at else ("start",))]
        return names + [f"after {s}" for s in (_shape(line[at + 1]) if at + 1 < len(line) else ("end",))]

    def _slopes(self, seen, gold, held) -> tuple[np.ndarray, np.ndarray]:
        """Gradient of the penalised log-likelihood, by forward and backward sums."""
        n, width, _ = seen.shape
        size = len(LABELS)
        score = seen @ self.weights
        step = self.next + self.barred
        forward = np.zeros((n, width, size))
        backward = np.zeros((n, width, size))
        forward[:, 0] = score[:, 0] + self.opening
        for t in range(1, width):
            reach = _log_sum(forward[:, t - 1, :, None] + step, 1) + score[:, t]
            forward[:, t] = np.where(held[:, t, None], reach, forward[:, t - 1])
        total = _log_sum(forward[:, -1], 1)
        for t in range(width - 2, -1, -1):
            reach = _log_sum((backward[:, t + 1] + score[:, t + 1])[:, None, :] + step, 2)
            backward[:, t] = np.where(held[:, t + 1, None], reach, 0)
        chance = np.exp(forward + backward - total[:, None, None]) * held[..., None]
        target = np.eye(size)[gold] * held[..., None]
        by_feature = np.einsum("ntf,ntl->fl", seen, target - chance) - 0.02 * self.weights
        by_step = -0.02 * self.next
        for t in range(1, width):
            joint = forward[:, t - 1, :, None] + step + (score[:, t] + backward[:, t])[:, None, :]
            joint = np.exp(joint - total[:, None, None]) * held[:, t, None, None]
            pair = target[:, t - 1, :, None] * target[:, t, None, :]
            by_step += (pair - joint).sum(axis=0)
        return by_feature, by_step

    def _part(self, role: str, token: str | None) -> np.ndarray:
        """What a token adds to the scores of its own place, or of a neighbour's."""
        key = role, token or ""
        if key not in self.known:
            if len(self.known) > 1 << 15:
                self.known.clear()
            shapes = _shape(token) if token is not None else ("start" if role == "before" else "end",)
            rows = [self.number[n] for n in (f"{role} {s}" for s in shapes) if n in self.number]
            self.known[key] = self.weights[rows].sum(axis=0)
        return self.known[key]

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The best labels of every sequence; those of like length are done together."""
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        step, lo = self.next + self.barred, 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * len(sequences[order[hi]]) * len(LABELS) <= DECODED:
                hi += 1
            mine = order[lo:hi]
            width = len(sequences[mine[-1]])
            score = np.zeros((len(mine), width, len(LABELS)))
            length = np.array([len(sequences[i]) for i in mine])
            for row, i in enumerate(mine):
                line = [None, *sequences[i], None]
                for at in range(1, len(line) - 1):
                    score[row, at - 1] = (
                        self._part("own", line[at]) + self._part("before", line[at - 1]) + self._part("after", line[at + 1])
                    )
            best, came = score[:, 0] + self.opening, np.zeros(score.shape, np.int8)
            for t in range(1, width):
                reach = best[:, :, None] + step
                came[:, t] = reach.argmax(axis=1)
                best = np.where((t < length)[:, None], reach.max(axis=1) + score[:, t], best)
            label = best.argmax(axis=1)
            path = np.zeros((len(mine), width), np.int64)
            for t in range(width - 1, -1, -1):
                path[:, t] = label
                label = np.where(t < length, came[np.arange(len(mine)), t, label], label)
            for row, i in enumerate(mine):
                found[i] = path[row, : length[row]]
            lo = hi
        return found


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _sequences(text: str) -> list[list[re.Match]]:
    """Runs of tokens around those that hold a digit or an at sign."""
    tokens, last, found = list(_TOKEN.finditer(text)), -1, []
    for at, token in enumerate(tokens):
        if _ACTIVE.search(token.group()):
            start = at - MARGIN if found and at - MARGIN <= last else max(at - MARGIN, 0)
            stop = min(at + MARGIN + 1, len(tokens))
            if found and start <= last:
                found[-1].extend(tokens[last:stop])
            else:
                found.append(tokens[start:stop])
            last = stop
    return found


def _added(text: str, sequence: list[re.Match], labels: np.ndarray, base: list[Span]) -> Iterator[Span]:
    at = 0
    while at < len(sequence):
        if not labels[at]:
            at += 1
            continue
        stop = at + 1
        while stop < len(sequence) and labels[stop] and LABELS[labels[stop]][0] == "I":
            stop += 1
        kind = KINDS.index(LABELS[labels[at]][2:])
        start, end = sequence[at].start(), sequence[stop - 1].end()
        while end > start and not (text[end - 1].isalnum()):
            end -= 1
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        at = stop
        if all(end <= s or e <= start for _, s, e in base) and _reads_as(kind, text[start:end]):
            yield kind, start, end


def spans_of(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Per text the pattern matches, and these together with what the field adds."""
    base = [base_spans(text) for text in texts]
    owners, sequences = [], []
    for row, text in enumerate(texts):
        for sequence in _sequences(text):
            owners.append(row)
            sequences.append(sequence)
    labels = field.decode([[t.group() for t in s] for s in sequences])
    added: dict[int, list[Span]] = {}
    for row, sequence, path in zip(owners, sequences, labels):
        if path.any():
            added.setdefault(row, []).extend(_added(texts[row], sequence, path, base[row]))
    return [(b, sorted(b + added.get(row, []))) for row, b in enumerate(base)]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def _suspects(column: pa.Array) -> np.ndarray:
    """Rows that hold a digit or an at sign, without which there is nothing to find."""
    data, offsets = flat(column)
    marks = np.concatenate(([0], np.cumsum(((data >= 48) & (data <= 57)) | (data == 64))))
    spelled = np.zeros(len(column), bool)
    opens = np.flatnonzero(((data == 40) | (data == 91)))
    if len(opens):  # "(at)" and "[at]" may stand without a digit
        opens = opens[opens + 2 < len(data)]
        opens = opens[((data[opens + 1] | 32) == 97) & ((data[opens + 2] | 32) == 116)]
        spelled[np.searchsorted(offsets, opens, side="right") - 1] = True
    return np.flatnonzero((marks[offsets[1:]] > marks[offsets[:-1]]) | spelled)


def _finder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in pieces(batches, "text", 1 << 22):
            n = batch.num_rows
            counts, digests, listed = np.zeros((n, len(KINDS)), np.int64), [nothing] * n, [""] * n
            rows = _suspects(batch.column("text"))
            texts = batch.column("text").take(pa.array(rows)).to_pylist()
            for row, (base, spans) in zip(rows, spans_of(texts, field)):
                for kind, _, _ in base:
                    counts[row, kind] += 1
                digests[row] = hashlib.sha256(_listed(base).encode()).hexdigest()
                listed[row] = _listed(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in counts.T), pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return run


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind; overlapping ones are replaced once."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redactor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in pieces(batches, "text", 1 << 22):
            rows = _suspects(batch.column("text"))
            column = batch.column("text")
            texts = column.take(pa.array(rows)).to_pylist()
            found = spans_of(texts, field)
            changed = [i for i, (_, spans) in enumerate(found) if spans]
            if changed:
                whole = column.to_pylist()
                for i in changed:
                    whole[rows[i]] = redacted(texts[i], found[i][1])
                column = pa.array(whole, pa.string())
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", column)

    return run


def find_personal_data(spark: SparkSession, docs: DataFrame, labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of ``docs``.

    The counts and the digest are of the pattern matches; ``spans`` lists these and what
    the field adds, which overlaps none of them. Places are code points, ends exclusive.
    The field is trained on the driver from ``labelled``, a table of some dozen lines.

    Null, empty and blank texts hold nothing: zero counts, the digest of the empty
    string, no spans. Long runs of digits or letters cost time in proportion to their
    length. Each row gives a row; other columns are ignored.
    """
    shared = spark.sparkContext.broadcast(Field(labelled))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return plain.mapInArrow(_finder(shared), f"doc_id long, {counts}, base_sha256 string, spans string")


def redact_personal_data(spark: SparkSession, docs: DataFrame, labelled: tuple[str, ...] = LABELLED) -> DataFrame:
    """``docs`` with all personal data in ``text`` replaced by ``<KIND>``; null stays null."""
    shared = spark.sparkContext.broadcast(Field(labelled))
    return docs.mapInArrow(_redactor(shared), docs.schema)
