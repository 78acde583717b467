"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The patterns find emails, IP addresses, payment cards and phone numbers. The model is to find what they miss: it
learns from a bounded sample of the documents, in windows of characters, both the patterns' spans and varied ones, in
which an address is spelled with ``(at)`` or has accents, a phone number has no plus sign or other separators, and a
card has fifteen digits. It reads every stretch of text that could hold personal data: all have a digit, ``@`` or
``(at)``, so windows lie around the words with these. Windows overlap; where two cover a character, the tag of the
window with more context around it holds, and the spans are read off the tags of the whole text. A span of the model
is added if it overlaps no span of the patterns, is likely (``LEAST_SHARE``) and has the form of its kind
(``well_formed``). Spans of the patterns always stay.

Offsets are code points, ends exclusive. Null and empty texts have no span. The sample is an expected
``SAMPLE_DOCS`` documents chosen by a hash of the id (rows with a null id aren't in it) and of their windows at
most ``MOST_WINDOWS``; without any span in it the model adds none. Repeated rows get the same answer each. An
empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm import bilstm_crf
from billscope.llm.frames import free_name

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, MOST_WINDOWS = 20_000, 1_200
LENGTH, STRIDE, MARGIN = 64, 32, 16
LEAST_SHARE = 0.95
AT_ONCE = 2_048  # windows decoded together, texts held at a time

# The patterns. Possessive and anchored forms of them match the same spans without retries.
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

TRIGGER = re.compile(r"[0-9@]+|[(\[] ?at ?[)\]]")
#: What a span of the model may look like beyond the patterns.
ADDRESS = re.compile(r"[^\s@()\[\]<>,;:]+(?:@| ?[(\[] ?at ?[)\]] ?)[\w-]+(?:(?:\.| ?[(\[] ?dot ?[)\]] ?)[\w-]+)+")
NUMBER = re.compile(r"[(+]?[0-9][0-9 ().+/-]*[0-9]")
ACCENTS = str.maketrans("aeiou", "\u00e4\u00e9\u00ed\u00f6\u00fc")
SIGNS = "@.-+()[] _%:/,\n"
#: Character classes: the rest, digit, small letter, large letter, other letter, then each sign.
CLASSES = 5 + len(SIGNS)
TAGS = 1 + 2 * len(KINDS)  # outside; first and inner character of each kind

SPANS = T.StructType(
    [
        T.StructField("kinds", T.ArrayType(T.StringType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
        T.StructField("base", T.ArrayType(T.BooleanType())),
    ]
)
Span = tuple[int, int, int]  # kind's number, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if place % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        found = AT_DOMAIN.match(text, at)
        start = at
        if found:
            while start > end and text[start - 1] in LOCAL:
                start -= 1
        if found and start < at:
            yield 0, start, found.end()
            end = found.end()
        else:
            end = at + 1  # a local part holds no @
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    spans = [*_emails(text)]
    for found in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found[0].split(".")):
            spans.append((1, *found.span()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 16 and 16 <= len(digits := _digits(found[0])) <= 19 and luhn(digits):
            spans.append((2, *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 8 <= len(_digits(found[0])) <= 15:
                spans.append((3, *found.span()))
    return spans


def well_formed(kind: int, text: str) -> bool:
    """Whether a span of the model can be of its kind."""
    digits = _digits(text)
    if kind == 0:
        return ADDRESS.fullmatch(text) is not None
    if kind == 1:
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and all(c in " -." for c in text if c not in digits)
    least = 8 if text[0] == "+" else 9  # dates have eight
    return least <= len(digits) <= 15 and len(digits) < len(text) and NUMBER.fullmatch(text) is not None


def varied(kind: int, text: str, draw: int) -> str | None:
    """A form of a span that the patterns miss, one of several by ``draw``; None where there is none."""
    digits = _digits(text)
    if kind == 0:
        name, _, host = text.partition("@")
        name = (name, "".join(filter(str.isalpha, name)) or name)[draw // 4 % 2]
        host = (host, ".".join(host.split(".")[-2:]), "".join(c for c in host if not c.isdigit()))[draw // 8 % 3]
        spelled = host.replace(".", " [dot] ")
        accented = f"{name}{name[:1]}u".translate(ACCENTS)
        forms = [f"{name} (at) {host}", f"{name}[at]{host}", f"{name} [at] {spelled}", f"{accented}@{host}"]
    elif kind == 2:
        short = digits[:14]
        short += next(str(d) for d in range(10) if luhn(short + str(d)))
        forms = [f"{short[:4]} {short[4:10]} {short[10:]}", f"{short[:4]}-{short[4:10]}-{short[10:]}", short]
    elif kind == 3 and len(digits) >= 10:
        own = digits[-10:]
        forms = [f"{own[:3]}{a}{own[3:6]}{b}{own[6:]}" for a, b in ("--", "..", "  ", " -")]
        forms += [f"({own[:3]}) {own[3:6]}-{own[6:]}", f"0{own[1:4]}/{own[4:]}", text.lstrip("+")]
    else:
        return None
    form = forms[draw % len(forms)]
    return None if base_spans(form) or not well_formed(kind, form) else form


def _class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.int8)
    table[48:58], table[97:123], table[65:91] = 1, 2, 3
    table[[c for c in range(128, 0x250) if chr(c).isalpha()]] = 4
    for number, sign in enumerate(SIGNS):
        table[ord(sign)] = 5 + number
    return table


_table: list[np.ndarray] = []


def classes_of(text: str) -> np.ndarray:
    if not _table:
        _table.append(_class_table())
    return _table[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]


SPACE = re.compile(r"\s")


def _run_start(text: str, end: int) -> int:
    """Where the white-space-free run before ``end`` begins."""
    while end > 0 and not text[end - 1].isspace():
        end -= 1
    return end


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches around words with digits, ``@`` or ``(at)``, cut into overlapping windows."""
    zones: list[list[int]] = []
    for found in TRIGGER.finditer(text):
        if zones and found.end() + MARGIN <= zones[-1][1]:
            continue
        before, after = _run_start(text, found.start()), SPACE.search(text, found.end())
        start, end = max(0, before - MARGIN), min(len(text), (after.start() if after else len(text)) + MARGIN)
        if zones and start <= zones[-1][1]:
            zones[-1][1] = end
        else:
            zones.append([start, end])
    out = []
    for start, end in zones:
        while end - start > LENGTH:
            out.append((start, start + LENGTH))
            start += STRIDE
        out.append((start, end))
    return out


def _padded(values: np.ndarray) -> np.ndarray:
    out = np.zeros(LENGTH, np.int8)
    out[: len(values)] = values
    return out


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with the tags of the patterns' spans."""
    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            cut = windows(text)
            if not cut:
                continue
            own, tags = classes_of(text), np.zeros(len(text), np.int8)
            spans = base_spans(text)
            for kind, start, end in spans:
                tags[start:end] = 2 + 2 * kind
                tags[start] = 1 + 2 * kind
            for (kind, start, end), bits in product(spans, (0, 8)):
                form = varied(kind, text[start:end], zlib.crc32(text[start:end].encode("utf-8", "replace")) >> bits)
                room = min(MARGIN, (LENGTH - len(form)) // 2) if form else -1
                first, last = max(0, start - room), end + room
                if room < 4 or tags[first:start].any() or tags[end:last].any():
                    continue
                inside = np.zeros(start - first + len(form) + len(text[end:last]), np.int8)
                inside[start - first : start - first + len(form)] = 2 + 2 * kind
                inside[start - first] = 1 + 2 * kind
                chars = classes_of(text[first:start] + form + text[end:last])
                rows.append((_padded(chars).tobytes(), _padded(inside).tobytes(), True))
            for start, end in cut:
                inside = tags[start:end]
                whole = not (len(inside) and inside[0] and inside[0] % 2 == 0)
                if whole:  # a window that begins inside a span teaches nothing about its start
                    rows.append((_padded(own[start:end]).tobytes(), _padded(inside).tobytes(), bool(inside.any())))
        if rows:
            columns = zip(*rows, strict=True)
            kinds = (pa.binary(), pa.binary(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["chars", "tags", "has"])


def labelled_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    most: int = MOST_WINDOWS,
) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of a bounded sample of windows: two thirds with a span, a third without."""
    count = docs.count()
    share = int(1_000_000 * min(1.0, sample_docs / max(count, 1)))
    own_id = F.col(f"`{id_col}`").cast("string")
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    chosen = docs.where(F.pmod(F.xxhash64(own_id), F.lit(1_000_000)) < share).select(text, own_id.alias("id"))
    found = chosen.where("text is not null and id is not null").select("text").mapInArrow(
        _training, "chars binary, tags binary, has boolean"
    )
    rows = []
    for has, n in ((True, 2 * most // 3), (False, most // 3)):
        part = found.where("has" if has else "not has").select("chars", "tags").distinct()
        rows += part.orderBy(F.xxhash64("chars", "tags"), "chars").limit(n).collect()
    chars = np.array([np.frombuffer(bytes(row[0]), np.int8) for row in rows], np.int64).reshape(-1, LENGTH)
    tags = np.array([np.frombuffer(bytes(row[1]), np.int8) for row in rows], np.int64).reshape(-1, LENGTH)
    return chars, tags


def learn(docs: DataFrame, **options) -> dict[str, np.ndarray] | None:
    """The model's weights, or None where the sample has no span."""
    chars, tags = labelled_windows(docs, **options)
    return bilstm_crf.train(chars, tags, CLASSES, TAGS) if tags.any() else None


def _read_tags(tags: np.ndarray, shares: np.ndarray, offset: int) -> list[tuple[int, int, int, float]]:
    """Spans of a stretch of tags with their mean probability."""
    out, t = [], 0
    while t < len(tags):
        if not tags[t]:
            t += 1
            continue
        kind, start = (tags[t] - 1) // 2, t
        t += 1
        while t < len(tags) and tags[t] == 2 + 2 * kind:
            t += 1
        out.append((int(kind), offset + start, offset + t, float(shares[start:t].mean())))
    return out


def model_spans(texts: list[str], weights: dict[str, np.ndarray]) -> list[list[tuple[int, int, int, float]]]:
    """What the model reads in each text: overlapping windows, reconciled over the whole text."""
    places = [(n, start, end) for n, text in enumerate(texts) for start, end in windows(text)]
    found: list[list] = [[] for _ in texts]
    cached = (-1, None)
    zone: list = []  # [text, start, tags, shares, context]

    def close() -> None:
        if zone:
            n, start, tags, shares, _ = zone
            found[n].extend(_read_tags(tags, shares, start))
            zone.clear()

    for at in range(0, len(places), AT_ONCE):
        own = places[at : at + AT_ONCE]
        chars = np.zeros((len(own), LENGTH), np.int64)
        for row, (n, start, end) in enumerate(own):
            if cached[0] != n:
                cached = (n, classes_of(texts[n]))
            chars[row, : end - start] = cached[1][start:end]
        tags, shares = bilstm_crf.decode(weights, chars)
        for (n, start, end), tag, share in zip(own, tags, shares, strict=True):
            size = end - start
            tag, share, room = tag[:size], share[:size], np.minimum(np.arange(size), np.arange(size)[::-1])
            if zone and zone[0] == n and start < zone[1] + len(zone[2]):
                shared = zone[1] + len(zone[2]) - start
                better = room[:shared] > zone[4][-shared:]
                for held, new in ((2, tag), (3, share), (4, room)):
                    mixed = np.where(better, new[:shared], zone[held][-shared:])
                    zone[held] = np.concatenate([zone[held][:-shared], mixed, new[shared:]])
            else:
                close()
                zone.extend([n, start, tag, share, room])
    close()
    return found


def all_spans(texts: list[str | None], weights: dict[str, np.ndarray] | None) -> list[list[tuple[int, int, int, bool]]]:
    """Spans of the patterns and those the model adds, by kind and start."""
    whole = [text or "" for text in texts]
    out = [[(*span, True) for span in base_spans(text)] for text in whole]
    if weights is None:
        return out
    for text, spans, read in zip(whole, out, model_spans(whole, weights), strict=True):
        taken = sorted((start, end) for _, start, end, _ in spans)
        for kind, start, end, share in read:
            clear = all(end <= a or b <= start for a, b in taken) if share >= LEAST_SHARE else False
            if clear and well_formed(kind, text[start:end]):
                spans.append((kind, start, end, False))
        spans.sort()
    return out


def _slices(batch: pa.Array) -> Iterator[list[str | None]]:
    """Texts, of which some are copied at a time."""
    return (batch.slice(at, AT_ONCE).to_pylist() for at in range(0, len(batch), AT_ONCE))


def spans_of(text: Column, weights: dict[str, np.ndarray] | None) -> Column:
    """Struct of the spans of a text column: kinds, starts, ends, whether a pattern found it."""

    @F.arrow_udf(SPANS)
    def own(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            rows = [row for texts in _slices(batch) for row in all_spans(texts, weights)]
            columns = [[[KINDS[s[0]] for s in spans] for spans in rows]]
            columns += [[[s[k] for s in spans] for spans in rows] for k in (1, 2, 3)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_())
            arrays = [pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]
            yield pa.StructArray.from_arrays(arrays, names=SPANS.names)

    return own.asNondeterministic()(text)


def with_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "pii", **options) -> DataFrame:
    """The documents with the struct of ``spans_of``; ``into`` gets underscores where there is such a column."""
    weights = learn(docs, id_col=id_col, text_col=text_col, **options)
    return docs.withColumn(free_name(docs, into), spans_of(F.col(f"`{text_col}`").cast("string"), weights))


def masked(text: str | None, spans: list[tuple[int, int, int, bool]]) -> str | None:
    """Text with each span replaced by its kind; spans that overlap are replaced together, by the first."""
    if not text or not spans:
        return text
    parts, at = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end, _ in spans):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with personal data replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``."""
    weights = learn(docs, id_col=id_col, text_col=text_col, **options)

    @F.arrow_udf(T.StringType())
    def own(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            out = []
            for some in _slices(batch):
                out += map(masked, some, all_spans(some, weights))
            yield pa.array(out, pa.string())

    return docs.withColumn(text_col, own.asNondeterministic()(F.col(f"`{text_col}`").cast("string")))
