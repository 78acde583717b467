"""Token ids of whole texts by the public tokenizers, encoded once per distinct word.

A tokenizer never merges across the points where a text is cut here, so encoding the parts and joining their
ids gives the ids of the whole text; the ids of a part are looked up when it returns. Texts are UTF-8 bytes,
ids are little-endian unsigned 32-bit bytes.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

WORDS, SPACED = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Parts that one Python worker remembers before it starts afresh, for tokenizers that drop white space and
#: for the others, and bytes of parts.
MOST_PARTS, MOST_BYTES = (700_000, 1_600_000), 32_000_000
MOST_MARKS = 8  # bytes of a run of marks whose ids are remembered
BATCH_BYTES = 64_000  # of texts that are encoded at a time: their parts stay in the cache

# White space as the tokenizers' patterns see it (Unicode White_Space).
SPACE = "\t-\r \x85\xa0  -     　"
ENDS_IN_SPACE = re.compile(f"[{SPACE}]\\Z")
RUN_AND_WORD = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
LINE, BARE = b"\xff", b"\xfe"  # bytes that UTF-8 never holds
COMBINING = re.compile(rb"[\xcc\xcd]")
#: A run of Latin letters, and a run of marks after it that begins no contraction: two tokens before merging.
WORD_AND_MARKS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~][!-/:-@\[-`{-~]*)?")
#: The same run in UTF-8, and the marks.
LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


def byte_letters() -> dict[int, int]:
    """Byte-level tokenizers write bytes as letters: visible Latin-1 as itself, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in visible]
    return {b: 256 + n for n, b in enumerate(others)}


LETTERS = byte_letters()


def location(name: str) -> str:
    """Path of a tokenizer file: a path as given, or a bare name among the public tokenizers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def word_parts(text: bytes) -> list[bytes]:
    """Cut at ASCII white space, for tokenizers that lower the case and drop white space.

    Small letters come first only where no accent could combine with a letter.
    """
    if not COMBINING.search(text):
        text = text.lower()
    return text.split()


def spaced_parts(text: bytes) -> list[bytes]:
    """Cut before every space and line end, for byte-level tokenizers.

    A space before a part is implied; ``LINE`` stands for a line end before it and ``BARE`` for nothing. Right
    unless a part ends in white space, whose run the cut after it would split; ``visible_end`` tells.
    """
    if not text:
        return []
    first, *rest = text.replace(b"\n", b" " + LINE).split(b" ")
    return [BARE + first, *rest]


def run_parts(text: bytes) -> list[bytes]:
    """Cut only before runs of white space, for texts that ``spaced_parts`` can't cut."""
    return [BARE + part.encode() for part in RUN_AND_WORD.findall(text.decode())]


def visible_end(text: str) -> bool:
    return bool(text) and not ENDS_IN_SPACE.search(text)


def part_text(part: bytes) -> str:
    lead = part[:1]
    if lead == BARE:
        return part[1:].decode()
    return "\n" + part[1:].decode() if lead == LINE else " " + part.decode()


class Encoder:
    """Encodes texts with one tokenizer file; keep one per Python worker.

    Special-token strings inside texts get their own ids, as the library's call gives them; with ``escape`` they are
    ordinary text.
    """

    def __init__(self, name: str, escape: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(location(name))
        self.tokenizer.encode_special_tokens = escape
        added = {} if escape else self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word or not t.special for t in added.values()):
            raise ValueError(f"{name} has added tokens that aren't plain strings")
        self.special = {token.content.encode(): array("I", [number]).tobytes() for number, token in added.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile(b"(" + b"|".join(map(re.escape, longest)) + b")") if longest else None
        drops_space = os.path.basename(name) == WORDS
        self.parts, self.text = (word_parts, bytes.decode) if drops_space else (spaced_parts, part_text)
        self.lowers, self.lead = drops_space, "" if drops_space else chr(LETTERS[32])
        self.most = MOST_PARTS[not drops_space]
        self.merge = self.tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.marks: dict[bytes, bytes] = {}
        self.unsafe: set[bytes] = set()  # parts that end in white space
        self.last: set[bytes] = set()
        self.bytes = 0

    def _merged(self, letters: str) -> bytes:
        return array("I", [token.id for token in self.merge(letters)]).tobytes()

    def _ids_of_word(self, part: bytes) -> bytes | None:
        """Ids of a word with the marks after it, which need no normalising or cutting; None for other parts.

        Words and marks are looked up and merged each by themselves, so a word is merged once, whatever follows it.
        """
        word = part.rstrip(MARKS)
        marks = part[len(word) :]
        if marks[:1] == b"'" or not (word.isalpha() or LATIN.fullmatch(word)):
            return self._ids_of_text(self.text(part))
        ids = self.known.get(word)
        if ids is None:
            letters = word.decode()
            letters = letters.lower() if self.lowers else letters
            letters = letters if word.isalpha() else letters.encode().decode("latin-1").translate(LETTERS)
            ids = self.known[word] = self._merged(self.lead + letters)
            self.bytes += len(word)
        if not marks:
            return ids
        after = self.marks.get(marks)
        if after is None:
            after = self._merged(marks.decode())
            if len(marks) <= MOST_MARKS and len(self.marks) < self.most:
                self.marks[marks] = after
        return ids + after

    def _ids_of_text(self, text: str) -> bytes | None:
        """The same for a part with or without a space before it."""
        found = WORD_AND_MARKS.fullmatch(text)
        if not found:
            return None
        word, marks = found.groups()
        letters = (word.lower() if self.lowers else word).encode().decode("latin-1").translate(LETTERS)
        return self._merged(letters) + (self._merged(marks) if marks else b"")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; the library takes what lies between special tokens as texts of their own."""
        if self.special_at is None or not any(map(self.special_at.search, texts)):
            return self._encode(texts)
        pieces = [self.special_at.split(text) for text in texts]
        plain = iter(self._encode([piece for own in pieces for piece in own[::2]]))
        return [b"".join(self.special[p] if k % 2 else next(plain) for k, p in enumerate(own)) for own in pieces]

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        parts = [self.parts(text) for text in texts]
        distinct = self._learn(set().union(*parts))
        if not self.lowers and not self.unsafe.isdisjoint(distinct):
            for number, own in enumerate(parts):
                if not self.unsafe.isdisjoint(own):
                    parts[number] = run_parts(texts[number])
            self._learn(set().union(*parts))
        self.last = distinct
        look_up = self.known.__getitem__
        return [b"".join(map(look_up, own)) for own in parts]

    def forget(self) -> None:
        """Keep only the parts of the last texts, so that an idle worker holds little."""
        self.known = {part: self.known[part] for part in self.last if part in self.known}
        self.bytes = sum(map(len, self.known))

    def _learn(self, distinct: set[bytes]) -> set[bytes]:
        """Encode the parts that aren't known."""
        new = distinct.difference(self.known)
        size = sum(map(len, new))
        if len(self.known) + len(new) > self.most or self.bytes + size > MOST_BYTES:
            self.known, self.unsafe, self.bytes, new = {}, set(), 0, distinct
            size = sum(map(len, new))
        self.bytes += size
        whole = []
        for part in new:
            ids = self._ids_of_word(part)
            if ids is None:
                whole.append(part)
            else:
                self.known[part] = ids
        for at in range(0, len(whole), 20_000):
            some = whole[at : at + 20_000]
            written = [self.text(part) for part in some]
            encoded = self.tokenizer.encode_batch_fast(written, add_special_tokens=False)
            self.known.update((part, array("I", e.ids).tobytes()) for part, e in zip(some, encoded, strict=True))
            self.unsafe.update(part for part, text in zip(some, written, strict=True) if not visible_end(text))
        return distinct


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, escape: bool = False) -> Encoder:
    """The worker's encoder for this file."""
    if (name, escape) not in _encoders:
        _encoders[name, escape] = Encoder(name, escape)
    return _encoders[name, escape]


def encoded(
    rows: Iterable[tuple], name: str, text_at: int, remember: bool = False, escape: bool = False
) -> Iterator[tuple[tuple, bytes]]:
    """Each row with the ids of its text (None: empty), some texts at a time.

    ``remember`` keeps the words for the worker's next task, as many as ``MOST_PARTS`` allows.
    """
    own, size = [], 0
    own_encoder = encoder(name, escape)
    encode = own_encoder.encode
    for row in rows:
        own.append(row)
        size += len(row[text_at] or b"")
        if size >= BATCH_BYTES:
            yield from zip(own, encode([r[text_at] or b"" for r in own]), strict=True)
            own, size = [], 0
    if own:
        yield from zip(own, encode([r[text_at] or b"" for r in own]), strict=True)
    if not remember:
        own_encoder.forget()
